"""LM scoring by subword lattice likelihood.

The vocabulary is that of an existing tokenizer file: pieces with scores.  A
text is its tokens, words and one end; a word, ``▁`` before it, is a lattice of
all ways to put it together from pieces, and its probability is the sum over
all of them of the product of their pieces' probabilities (forward recursion in
log space).  No piece reaches over a word's end, so the probability of a text
is the product of its tokens'.

The file's scores are merge ranks, so a piece of rank r starts at a weight of
1 / (r + RANK_SHIFT).  Rounds of expected counts over all training words
(forward and backward) replace these weights by the pieces' share in the
training text, each plus ``SMOOTHING`` counts.  The rounds end with the first
one whose weights had made the training words' log probability less than
``GAIN`` better than the weights before, or after ``ROUNDS``.  A character that
is no piece stands for its bytes.

Distribution.  Words are counted once (``_count``: per task in bounded tables,
then one shuffle).  The word table then has each distinct word's counts and
log10 probability, so the lattice is run once per distinct word.  The most
frequent words, at most ``COMMON`` of at most ``COMMON_BYTES`` bytes, are
broadcast and added up where the texts are read; of the others each text sends
a row per distinct word to the word table.  No word outside the broadcast
fills a task: such a word makes up less than 1 / COMMON of the tokens, or is
long and then split by the skew join.

Cases: a null or empty text is the end token alone.  Repeated rows are scored
alike, and all count.  A null doc_id counts as the text '', so it is held out.
An empty training set gives N = V = 0 and the starting weights.  Very long
words go through the lattice one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
RANK_SHIFT = 10.0
GAIN = 0.005
ROUNDS = 20
SMOOTHING = 0.1
#: Words whose characters are at most this many share a matrix.
TOGETHER = 64
COMMON = 1 << 17
COMMON_BYTES = 256
#: Words, and their bytes, that go through the lattice in one go.
GATHERED, GATHERED_BYTES = 1 << 16, 16 << 20
#: Distinct words that a task counts before it passes them on.
HELD = 300_000
MARK = "▁"
#: In place of a piece: the row with the words' log probability.
WHOLE = -1
PRIME = np.uint64(0x100000001B3)   # as in Lattice._hashes
LN10 = float(np.log(10))


def word_list(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased: what bytes' own methods do."""
    return (text or b"").lower().split()


class Lattice:
    """Pieces and their log probabilities.  ``logp`` has the pieces in the
    order of ``pieces``, then the 256 bytes."""

    def __init__(self, pieces: list[str], logp: np.ndarray):
        self.pieces, self.logp = pieces, logp
        self.number = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        starts = [self._hashes(p) for p in pieces]
        self.hashes = np.array([h[-1] for h in starts], np.uint64)
        if len(np.unique(self.hashes)) < len(pieces):
            raise ValueError("two pieces have one hash")
        self.slots, rest = [], np.arange(len(pieces), dtype=np.int32)   # pieces by slot; those that find theirs taken go to the next table
        while len(rest) or not self.slots:
            table, slot = np.full(1 << 20, -1, np.int32), self._slot(self.hashes[rest])
            table[slot[::-1]] = rest[::-1]
            self.slots.append(table)
            rest = rest[table[slot] != rest]
        self.begun = np.zeros(1 << 22, bool)   # by slot: may be how a piece begins
        self.begun[self._slot(np.array([h for hs in starts for h in hs], np.uint64), 22)] = True

    @staticmethod
    def _hashes(piece: str) -> list[int]:
        """The hashes of the piece's beginnings; the last is its own."""
        h, out = 0, []
        for c in piece:
            h = (h * 0x100000001B3 + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            out.append(h)
        return out

    @staticmethod
    def _slot(hashes: np.ndarray, bits: int = 20) -> np.ndarray:
        return (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)

    def _standing(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows whose hash is a piece's, and these pieces."""
        slot = self._slot(h)
        rows, out = np.flatnonzero(self.slots[0][slot] >= 0), []
        for table in self.slots:
            piece = table[slot[rows]]
            real = (piece >= 0) & (self.hashes[piece] == h[rows])
            out.append((rows[real], piece[real]))
            rows = rows[~real & (piece >= 0)]
            if not len(rows):
                break
        return tuple(np.concatenate(x) for x in zip(*out)) if len(out) > 1 else out[0]

    def bytes_of(self, character: str) -> list[int]:
        return [len(self.pieces) + b for b in character.encode("utf-8", "surrogatepass")]

    def _edges(self, chars: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """For words of one length (a row each): (start, end, rows, pieces) of
        all pieces that stand there, by start."""
        edges, n, length = [], *chars.shape
        columns = np.ascontiguousarray(chars.T) + np.uint64(1)
        for i in range(length):
            left, h = np.arange(n), np.zeros(n, np.uint64)   # the rows that a piece may still follow
            for j in range(i + 1, min(length, i + self.longest) + 1):
                h = h * PRIME + columns[j - 1][left]
                on = np.flatnonzero(self.begun[self._slot(h, 22)])
                left, h = left[on], h[on]
                if not len(left):
                    break
                rows, pieces = self._standing(h)
                if len(rows):
                    edges.append((i, j, left[rows], pieces))
        return edges

    def _unknown(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per place, the log probability of its character's bytes; -inf where the character is a piece."""
        distinct, at = np.unique(chars, return_inverse=True)
        cost = np.array([-np.inf if chr(c) in self.number else self.logp[self.bytes_of(chr(c))].sum() for c in distinct.tolist()])
        return cost[at].reshape(chars.shape), distinct

    def together(self, words: list[str], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """ln probabilities of words of one length; with weights, also the
        expected counts of the pieces and bytes."""
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64)
        n, length = chars.shape
        edges, (unknown, distinct) = self._edges(chars), self._unknown(chars)
        odd = np.isfinite(unknown).any(axis=0)   # places where some word has a character that is no piece
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0
        by_start: list[list] = [[] for _ in range(length)]
        for e in edges:
            by_start[e[0]].append(e)
        for i in range(length):
            if odd[i]:
                alpha[i + 1] = np.logaddexp(alpha[i + 1], alpha[i] + unknown[:, i])
            for _, j, rows, piece in by_start[i]:
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + self.logp[piece])
        if weights is None:
            return alpha[length], None
        counts = np.zeros(len(self.logp))
        beta = np.full((length + 1, n), -np.inf)
        beta[length] = 0
        for i in range(length - 1, -1, -1):
            if odd[i]:
                beta[i] = beta[i + 1] + unknown[:, i]
                part = np.exp(alpha[i] + beta[i] - alpha[length]) * weights
                for c in distinct.tolist():
                    if chr(c) not in self.number:
                        share = part[chars[:, i] == c].sum()
                        np.add.at(counts, self.bytes_of(chr(c)), share)
            for _, j, rows, piece in by_start[i]:
                through = self.logp[piece] + beta[j, rows]
                beta[i, rows] = np.logaddexp(beta[i, rows], through)
                counts += np.bincount(piece, np.exp(alpha[i, rows] + through - alpha[length, rows]) * weights[rows], len(counts))
        return alpha[length], counts

    def alone(self, word: str, weight: float | None = None) -> tuple[float, np.ndarray | None]:
        """As ``together``, for one word of any length."""
        length = len(word)

        def edges(i: int) -> list[tuple[int, float, list[int]]]:
            out = [(j, self.logp[k], [k]) for j in range(i + 1, min(length, i + self.longest) + 1)
                   if (k := self.number.get(word[i:j])) is not None]
            if word[i] not in self.number:
                b = self.bytes_of(word[i])
                out.append((i + 1, self.logp[b].sum(), b))
            return out

        alpha = np.full(length + 1, -np.inf)
        alpha[0] = 0
        for i in range(length):
            for j, s, _ in edges(i):
                alpha[j] = np.logaddexp(alpha[j], alpha[i] + s)
        if weight is None:
            return float(alpha[-1]), None
        counts, beta = np.zeros(len(self.logp)), np.full(length + 1, -np.inf)
        beta[-1] = 0
        for i in range(length - 1, -1, -1):
            for j, s, ks in edges(i):
                beta[i] = np.logaddexp(beta[i], s + beta[j])
                np.add.at(counts, ks, np.exp(alpha[i] + s + beta[j] - alpha[-1]) * weight)
        return float(alpha[-1]), counts

    def run(self, words: list[bytes], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """ln probabilities of words, and expected counts if weighted."""
        texts = [MARK + w.decode("utf-8", "replace") for w in words]
        out = np.zeros(len(texts))
        counts = None if weights is None else np.zeros(len(self.logp))
        by_length: dict[int, list[int]] = {}
        for k, t in enumerate(texts):
            by_length.setdefault(min(len(t), TOGETHER + 1), []).append(k)
        for length, ks in by_length.items():
            for at in range(0, len(ks), 4096):
                part = ks[at:at + 4096]
                if length <= TOGETHER:
                    found = [(part, *self.together([texts[k] for k in part], None if weights is None else weights[part]))]
                else:
                    found = [([k], *self.alone(texts[k], None if weights is None else weights[k])) for k in part]
                for which, p, c in found:
                    out[which] = p
                    if counts is not None:
                        counts += c
        return out, counts


def read_pieces(path: str) -> tuple[list[str], np.ndarray]:
    """A sentencepiece vocabulary's pieces, by rank, and the starting log
    weights of these and the 256 bytes.  Pieces with a mark inside span
    words; they, control pieces and byte pieces are left out."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(m.get_piece_size())
           if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i)) and MARK not in m.id_to_piece(i)[1:]]
    ids.sort(key=lambda i: (-m.get_score(i), i))
    weights = np.append(1 / (np.arange(len(ids)) + RANK_SHIFT), np.full(256, 1 / (len(ids) + RANK_SHIFT)))
    return [m.id_to_piece(i) for i in ids], np.log(weights / weights.sum())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, train) -> (word, n, n_train), a row per word and task or more."""
    seen, train = Counter(), Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64()),
                                           pa.array([train[w] for w in seen], pa.int64())], ["word", "n", "n_train"])

    for batch in batches:
        for text, learn in zip(batch.column(0).cast(pa.binary()), batch.column(1)):
            words = word_list(text.as_py())
            seen.update(words)
            if learn.as_py():
                train.update(words)
            if len(seen) > HELD:
                yield out()
                seen.clear()
                train.clear()
    yield out()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together: the lattice takes words of one length at once."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= GATHERED or size >= GATHERED_BYTES:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


def _expected(lattice: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = 0, 0.0
        for words in _gathered(batches):
            n = words.column(1).to_numpy().astype(float)
            p, found = lattice().run(words.column(0).to_pylist(), n)
            counts, total = counts + found, total + float(p @ n)
        if not np.isscalar(counts):
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, WHOLE].astype(np.int32)), pa.array(np.r_[counts[at], total])], ["piece", "n"])

    return run


def _likelihood(lattice: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _gathered(batches):
            p = lattice().run(words.column(0).to_pylist())[0] / LN10
            yield from words.append_column("logp", pa.array(p)).to_batches()

    return run


def _shared_lattice(spark, pieces: list[str], logp: np.ndarray) -> Callable:
    """The lattice, built once per Python worker from what is broadcast."""
    sent, built = spark.sparkContext.broadcast((pieces, logp)), {}

    def get() -> Lattice:
        if not built:
            built[0] = Lattice(*sent.value)
        return built[0]

    return get


def _summary(common) -> Callable:
    """(row, doc_id, text, held_out) -> per text its common words added up, on
    the first of its rows, and a row for each other distinct word.  A text
    without others gets a row of a key that no word is (it begins with a space)."""
    schema = pa.schema([("row", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("doc", pa.struct(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()),
         ("base", pa.float64()), ("score", pa.float64())]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = common.value
        for batch in batches:
            rows, words, ns, docs = [], [], [], []
            ids, keys, texts, held = batch.columns
            for key, doc_id, text, out in zip(ids.to_pylist(), keys.to_pylist(), texts.cast(pa.binary()), held.to_pylist()):
                counts = Counter(word_list(text.as_py()))
                known, base, score, others = 0, 0.0, 0.0, []
                for w, n in counts.items():
                    if (found := table.get(w)) is None:
                        others.append(w)
                    else:
                        known += n * found[0]
                        base += n * found[1]
                        score += n * found[2]
                total = counts.total() + 1
                if not others:
                    others.append(b" %d" % key)
                rows += [key] * len(others)
                words += others
                ns += [counts[w] for w in others]
                docs.append({"doc_id": doc_id, "held_out": out, "n_tokens": total, "known": known, "base": base, "score": score})
                docs += [None] * (len(others) - 1)
                if len(rows) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((rows, words, ns, docs), schema)], schema=schema)
                    rows, words, ns, docs = [], [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((rows, words, ns, docs), schema)], schema=schema)

    return run


def _common_words(table: DataFrame) -> DataFrame:
    """The most frequent words: all whose count is at least the smallest that
    leaves at most COMMON of them.  Counts fall into classes of a quarter power of two."""
    step = F.floor(F.log2("n") * 4)
    short = table.where(F.octet_length("word") <= COMMON_BYTES)
    classes = sorted(((r["step"], r["k"]) for r in short.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect()), reverse=True)
    least, k = None, 0
    for s, here in classes:  # some 250 classes at most: counts are 64-bit numbers
        if (k := k + here) > COMMON:
            break
        least = s
    return short.where(F.lit(False) if least is None else step >= least)


def lm_scores(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"))
    counted = materialize(docs.select("text", ~F.col("held_out")).mapInArrow(_count, "word binary, n long, n_train long")
                          .groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train")), "words")
    ends = docs.where("not held_out").count()
    total, distinct = counted.where("n_train > 0").agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count("*")).first()
    total, distinct = total + ends, distinct + bool(ends)
    # a vocabulary's pieces come to the driver and go out again, never words
    pieces, logp = read_pieces(vocabulary)
    before = -np.inf
    for _ in range(ROUNDS):
        expected = (counted.where("n_train > 0").select("word", "n_train")
                    .mapInArrow(_expected(_shared_lattice(spark, pieces, logp)), "piece int, n double")
                    .groupBy("piece").agg(F.sum("n").alias("n")))
        found = {r["piece"]: r["n"] for r in expected.collect()}
        if not found:
            break
        whole = found.pop(WHOLE)
        share = np.full(len(logp), SMOOTHING)
        share[list(found)] += list(found.values())
        logp = np.log(share / (share.sum() + ends))
        if whole - before < GAIN * abs(whole):
            break
        before = whole
    end_logp = float(np.log10(max(ends, SMOOTHING) / (total + 1)))
    table = (counted.mapInArrow(_likelihood(_shared_lattice(spark, pieces, logp)), "word binary, n long, n_train long, logp double"))
    floor = 0.1 * (distinct + 1) + total
    table = materialize(table.select("word", "n", (F.col("n_train") > 0).cast("int").alias("known"),
                                     F.log10((F.col("n_train") + 0.1) / floor).alias("base"), "logp"), "likelihoods")
    common = {bytes(r["word"]): (r["known"], r["base"], r["logp"]) for r in _common_words(table).collect()}
    summary = _summary(spark.sparkContext.broadcast(common))
    rows = (docs.select(F.monotonically_increasing_id(), "doc_id", "text", "held_out")
            .mapInArrow(summary, "row long, word binary, n long, doc struct<doc_id:long,held_out:boolean,n_tokens:long,known:long,base:double,score:double>"))
    none = F.lit(0.0)
    joined = rows.join(table.select("word", "known", "base", "logp"), "word", "left")
    scored = joined.groupBy("row").agg(
        F.max("doc").alias("doc"), F.sum(F.coalesce(F.col("n") * F.col("known"), F.lit(0))).alias("known"),
        F.sum(F.coalesce(F.col("n") * F.col("base"), none)).alias("base"),
        F.sum(F.coalesce(F.col("n") * F.col("logp"), none)).alias("score"))
    end_base = float(np.log10((ends + 0.1) / floor))
    return scored.select(
        "doc.doc_id", "doc.held_out", "doc.n_tokens",
        (F.col("doc.known") + F.col("known") + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("doc.base") + F.col("base") + end_base).alias("base_score"),
        (F.col("doc.score") + F.col("score") + end_logp).alias("score"))
