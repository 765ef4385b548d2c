"""Suffix dedup, token alignment and spelling variants against brute force."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wakeline.llm import spelling, suffix_dedup, token_align

SCHEMA = "doc_id long, text string, d string, t string, h int, word string, run int, n int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", k, "w", k, 7) for k, (i, t) in enumerate(rows)], SCHEMA)


def prose(seed, n, size=400):
    r = np.random.default_rng(seed)
    vocabulary = ["".join(r.choice(list("abcdefghilmnoprstué"), r.integers(2, 9))) for _ in range(size)]
    return " ".join(r.choice(vocabulary, n))


# ------------------------------------------------------------- suffix dedup
def brute_repeats(rows):
    n = suffix_dedup.LENGTH
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - n + 1):
            if data[s:s + n] in seen:
                gone[s:s + n] = True
            seen.add(data[s:s + n])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def repeat_rows():
    base, shared = [prose(s, 120) for s in range(6)], prose(50, 40)
    rows = [(10 + i, t) for i, t in enumerate(base)]
    rows += [(30, base[0]), (5, base[0]), (5, base[1]), (31, base[2][:300] + "ZZ" + base[2][300:]), (32, base[3][137:]), (33, base[4][:99]), (34, base[4][:100])]
    rows += [(40 + i, prose(60 + i, 30) + shared + prose(80 + i, 30)) for i in range(9)]
    rows += [(60, shared + " " + shared + "x" + shared), (61, "ha " * 300), (62, "a" * 700), (63, "ha " * 100), (64, "é" * 130 + "日本語" * 60), (65, "日本語" * 70)]
    rows += [(70, None), (71, ""), (None, base[5]), (None, None), (72, "x" * 99), (73, "ab" * 50), (74, "ba" * 50 + "b")]
    return rows


@pytest.mark.parametrize("crowded, slice_bits, together", [(2048, 20, 50_000), (3, 9, 40), (0, 8, 1)])
def test_repeats_match_brute_force(spark, monkeypatch, crowded, slice_bits, together):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    rows = repeat_rows()
    data = [(d, t.encode()) for d, t in rows if t]
    if slice_bits < 20:     # the cutting itself, in small slices (tasks of Spark keep the module's own)
        monkeypatch.setattr(suffix_dedup, "SLICE_BITS", slice_bits)
        powers, got = suffix_dedup._Powers(), defaultdict(set)
        for buf, begin, size, number, offset in suffix_dedup._sliced([t for _, t in data]):
            of, lo, last, anchor, h, _ = suffix_dedup.cut(buf, begin, size, powers)
            for i, a, b in zip(of, lo, last):
                got[number[i]] |= set(range(a - begin[i] + offset[i], b - begin[i] + offset[i] + 1))
        assert all(got[i] == set(range(len(t) - 99)) for i, (_, t) in enumerate(data))
        monkeypatch.undo()
        monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    out = suffix_dedup.repeats(docs_of(spark, rows).repartition(3)).drop("spans").collect()
    assert Counter(tuple(r) for r in out) == brute_repeats(rows)


def noted_places(monkeypatch):
    """The stored places of the runs to come."""
    noted, keep = [], suffix_dedup.materialize
    monkeypatch.setattr(suffix_dedup, "materialize", lambda df, *a, **k: noted.append(keep(df, *a, **k)) or noted[-1])
    return noted


def test_short_common_phrases_are_not_asked_for_their_bytes(spark, monkeypatch):
    noted = noted_places(monkeypatch)
    phrase = "a phrase of forty bytes that many have. "
    rows = [(i, " ".join(prose(200 + 9 * i + k, 25, 60) + phrase for k in range(4))) for i in range(30)]
    out = suffix_dedup.repeats(docs_of(spark, rows).repartition(3)).drop("spans").collect()
    assert Counter(tuple(r) for r in out) == brute_repeats(rows)
    assert noted[0].count() == 0


@pytest.mark.parametrize("crowded", [0, 2, 8, 40])
def test_crowded_anchors_go_by_sides(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    noted = noted_places(monkeypatch)
    passages = [prose(900 + i, 20)[:n] for i, n in enumerate((58, 75, 99, 100, 101, 130))]
    rows = [(i * 7 % 31, prose(300 + i, 12) + passages[i % 6] + prose(400 + i // 3, 9) + passages[(i + i // 6) % 6] + prose(500 + i, 12)) for i in range(31)]
    out = suffix_dedup.repeats(docs_of(spark, rows).repartition(3)).drop("spans").collect()
    assert Counter(tuple(r) for r in out) == brute_repeats(rows)
    places = noted[0].where("NOT again").selectExpr("sum(IF(crowded, starts + 1, 0)) AS strings", "count(*) AS n").first()
    assert places["n"] and (places["strings"] > 0 if crowded < 8 else crowded == 8 or not places["strings"])


def test_repeated_rows_and_empty_table(spark):
    t = prose(3, 60)
    out = suffix_dedup.repeats(docs_of(spark, [(1, t), (1, t), (1, t), (2, "short"), (2, "short")])).collect()
    assert sorted(r["n_removed"] for r in out) == [0, 0, 0, len(t.encode()), len(t.encode())]
    assert [r["spans"] for r in out if r["n_removed"]] == [[(0, len(t.encode()))]] * 2
    assert suffix_dedup.repeats(docs_of(spark, [(1, t)]).where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_columns_find_equal_strings(seed):
    """Collections of random pieces over few symbols: every equal string, and no other."""
    r = np.random.default_rng(seed)
    n = suffix_dedup.LENGTH
    pieces, groups, anchors = [], [], []
    for g in range(12):
        base = bytes(r.integers(97, 99, 400).tolist())
        for _ in range(r.integers(1, 7)):
            left, starts = int(r.integers(0, 60)), int(r.integers(0, 30))
            p = bytearray(base[200 - left:200 - left + starts + n])
            if r.random() < 0.6:
                k = int(r.integers(0, len(p)))
                p[k] = 122
            pieces.append(bytes(p)), groups.append(g), anchors.append(left)
    groups, anchors, ages = np.array(groups), np.array(anchors), r.permutation(len(pieces))
    got = suffix_dedup.repeated_starts(pieces, groups, anchors, ages)
    oldest = {}
    strings = [(g, a - s, p[s:s + n], i, s) for i, (p, g, a) in enumerate(zip(pieces, groups.tolist(), anchors.tolist())) for s in range(len(p) - n + 1)]
    for g, k, x, i, _ in strings:
        oldest[g, k, x] = min(oldest.get((g, k, x), 1 << 60), ages[i])
    for g, k, x, i, s in strings:
        if k >= 0:
            assert got[i, k] == (ages[i] > oldest[g, k, x]), (i, k)


# ---------------------------------------------------------- token alignment
TEXTS = [None, "", "a", "Hello, world!", "Hello, world!", "  two  spaces \n\n and\ttabs", "naïve café résumé 日本語テキスト 😀😀", "▁ real mark", "<|endoftext|> <s> </s> <0x41>",
         "aaaa" * 200, "\u0000\x01\x7f", "१२३ ١٢٣", "don't  won't ﬁne ½", prose(1, 200), prose(1, 200), prose(2, 50), " leading", "trailing ", "🤷🏽‍♀️" * 40, "x" * 5000]


def brute_alignment(texts):
    a, b = token_align.side_a(token_align.TOKENIZER_A), token_align.side_b(token_align.TOKENIZER_B)
    docs, holders = [], Counter()
    for t in texts:
        groups = []
        if t:
            x, y = a.encode([t])[0], b.encode([t])[0]
            whole = b" " + t.encode()
            if b"".join(a.bytes[i] for i in x) == whole == b"".join(b.bytes[i] for i in y):
                ends = [set(itertools.accumulate(len(s.bytes[i]) for i in ids)) for s, ids in ((a, x), (b, y))]
                cuts = sorted(ends[0] & ends[1])
                split = [[], []]
                for k, (s, ids) in enumerate(((a, x), (b, y))):
                    at, own = 0, []
                    for i in ids:
                        own.append(i)
                        at += len(s.bytes[i])
                        if at in ends[0] & ends[1]:
                            split[k].append(own)
                            own = []
                groups = list(zip(*split))
                assert len(groups) == len(cuts)
        links = Counter((i, j) for p, q in groups for i in p for j in q)
        holders.update(links.keys())
        docs.append((groups, links))
    most = Counter()
    for (i, _), n in holders.items():
        most[i] = max(most[i], n)
    for groups, links in docs:
        spelled = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        yield (sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), sum(links.values()),
               sum(m for k, m in links.items() if holders[k] == most[k[0]]), sum(m * holders[k] for k, m in links.items()),
               hashlib.sha256(spelled.encode()).hexdigest() if groups else "")


@pytest.mark.parametrize("limits", [{}, {"RUN_BYTES": 60, "CALL_BYTES": 30, "FAN_IN": 2, "SMALL_GROUP": 1}])
def test_alignment_matches_brute_force(spark, monkeypatch, limits):
    texts = TEXTS + [prose(s, 40, 30) for s in range(30)]
    expected = list(brute_alignment(texts))
    if limits:      # Spark's tasks have the module's own limits: the same steps here, with small ones
        for k, v in limits.items():
            monkeypatch.setattr(token_align, k, v)
        task = type("Task", (), {"get": staticmethod(lambda: type("Context", (), {"partitionId": lambda self: 0})())})
        monkeypatch.setattr(token_align, "TaskContext", task)
        got = aligned_here(texts, limits["FAN_IN"])
    else:
        out = token_align.align(docs_of(spark, list(enumerate(texts))).repartition(3)).collect()
        got = {r["doc_id"]: tuple(r)[1:] for r in out}
    assert [got[i] for i in range(len(texts))] == expected
    assert expected[7][0] == 0 and expected[8][0] > 0      # a real U+2581 cannot be told from a space


def aligned_here(texts, fan_in):
    import pyarrow as pa
    encode = token_align._encoder(token_align.TOKENIZER_A, token_align.TOKENIZER_B, 8, pa.int64())
    t = pa.Table.from_batches(encode(iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])])))
    width = max(len(token_align.side_a(token_align.TOKENIZER_A).bytes), 32000)
    runs = t.filter(pa.compute.less(t["local"], 0))
    assert len(set(runs["run"].to_pylist())) > 5
    rows = []
    for r in range(8):
        of = runs.filter(pa.compute.equal(runs["radix"], r))
        if of.num_rows:
            levels = [of.slice(k, fan_in) for k in range(0, of.num_rows, fan_in)]
            while True:
                merged = [token_align._merge_level(x.append_column("part", pa.array([0] * x.num_rows, pa.int64()))) for x in levels]
                if len(merged) == 1:
                    break
                levels = [pa.concat_tables(merged[k:k + fan_in]).drop(["part"]) for k in range(0, len(merged), fan_in)]
            rows.append(token_align._contributions(width)(of, merged[0]))
    rows = pa.concat_tables(rows)
    totals = [token_align._totals(rows.filter(pa.compute.equal(rows["run"], k))) for k in set(rows["run"].to_pylist())]
    sums = {(r["run"], r["local"]): r for r in pa.concat_tables(totals).to_pylist()}
    none = {"n_best": 0, "count_sum": 0}
    return {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], (s := sums.get((r["run"], r["local"]), none))["n_best"], s["count_sum"], r["groups_sha256"])
            for r in t.to_pylist() if r["local"] >= 0}


def test_alignment_of_odd_tables(spark):
    out = token_align.align(docs_of(spark, [(None, None), (None, "one two"), (3, "one two"), (3, "one two"), (4, "")])).collect()
    assert sorted((r["n_a"], r["n_best"], r["count_sum"]) for r in out) == [(0, 0, 0), (0, 0, 0), (2, 2, 6), (2, 2, 6), (2, 2, 6)]
    assert token_align.align(docs_of(spark, [(1, ""), (2, None)])).count() == 2
    assert token_align.align(docs_of(spark, [(1, "a")]).where("doc_id < 0")).count() == 0


def test_ranked_encoder_is_the_tokenizer():
    """Every character that it takes, in company of each kind, and prose."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_align.TOKENIZER_A)
    t.encode_special_tokens = True
    side = token_align.side_a(token_align.TOKENIZER_A)
    quick = token_align.ranked(token_align.TOKENIZER_A, side.bytes)
    shapes = ["{0}", "a{0}b", "1{0}2", " {0} ", "{0}{0}{0}", "x {0}", "\n{0}\n\n", "'{0}", "é{0}!"]
    texts = [s.format(chr(c)) for c in range(0x250) for s in shapes] + [prose(s, 300) for s in range(5)] + ["<|endoftext|>", "  " * 300, "\t \n" * 100, "a" * 3000]
    r = np.random.default_rng(5)
    texts += ["".join(chr(int(c)) for c in r.choice(0x250, 40)) for _ in range(300)]
    assert not any(token_align.RANKED.search(x) for x in texts) and token_align.RANKED.search("日")
    whole = [" " + x for x in texts]
    assert [quick(x) for x in whole] == [e.ids for e in t.encode_batch(whole, add_special_tokens=False)]


def test_counts_are_packed_whole():
    for v in ([], [0], [255], [256], [1 << 20], [1 << 40, 0]):
        assert token_align.unpack(token_align.pack(np.array(v, np.int64))).tolist() == v


# --------------------------------------------------------- spelling variants
def brute_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def brute_variants(rows):
    n = brute_words(rows)
    near = {w: [x for x in n if x != w and one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None


def variant_rows(seed, docs=120):
    r = np.random.default_rng(seed)
    base = ["".join(r.choice(list("abcé"), r.integers(5, 10))) for _ in range(40)] + ["Überfluß", "aaaaaa", "aaaaaaa", "aaaaaaaa", "STRASSE×", "x" * 300, "x" * 301]
    weights = 1 / np.arange(1, len(base) + 1) ** 1.5
    rows = []
    for i in range(docs):
        words = [str(w) for w in r.choice(base, 60, p=weights / weights.sum())]
        for k in np.flatnonzero(r.random(60) < 0.15):
            at = int(r.integers(0, len(words[k])))
            words[k] = words[k][:at] + str(r.choice(["", "b", "É", "zz"])) + words[k][at + 1:]
        rows.append((i, "1, ".join(words)))
    return rows + [(None, "aaaaaa abcabc"), (None, None), (500, ""), (3, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_match_brute_force(spark, seed):
    rows = variant_rows(seed)
    rows += [(900 + i, " ".join(w for w, n in (("chained", 600), ("chaimed", 90), ("chaimad", 12)) for _ in range(n // 6))) for i in range(6)]
    out = spelling.variants(docs_of(spark, rows).repartition(3)).collect()
    assert Counter(tuple(r) for r in out) == Counter(brute_variants(rows))
    assert any(r["form"] and r["root"] != r["form"] for r in out)


def test_tiles_of_crowded_halves(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 3)      # read by the driver alone
    rows = variant_rows(5)
    tiles = spelling._dealt(spelling.word_counts(docs_of(spark, rows)))
    assert tiles.where("i < j").count() > 0
    assert Counter(tuple(r) for r in spelling.variants(docs_of(spark, rows)).collect()) == Counter(brute_variants(rows))


def test_variants_of_empty_table(spark):
    assert spelling.variants(docs_of(spark, [(1, "a")]).where("doc_id < 0")).count() == 0
    assert spelling.variants(docs_of(spark, [(1, None), (2, "few words here")])).count() == 0
