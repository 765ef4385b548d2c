"""DuckDB text for the drift oracle: baselines, binning and PSI over long rows."""

from __future__ import annotations

from .sqltext import q

EPS = "1e-6"


def term(comp: str, ref: str, kind: str = "psi") -> str:
    c, r = f"greatest({comp}, {EPS})", f"greatest({ref}, {EPS})"
    if kind == "psi":
        return f"(({c}) - ({r})) * ln(({c}) / ({r}))"
    return f"({c}) * ln(({c}) / ({r}))"


def long_sql(src: str, features: list[str], with_period: bool) -> str:
    per = "period, " if with_period else ""
    parts = [f"SELECT class, {per}{q(f)} AS feature, CAST({f} AS DOUBLE) AS value FROM {src} "
             f"WHERE {f} IS NOT NULL" for f in features]
    return "\nUNION ALL\n".join(parts)


def baseline_ctes(base: str, features: list[str], n_bins: int = 10) -> list[tuple[str, str]]:
    """base: CTE with (class, features...) -> edges, bins(feature, class, bin, lo, hi, ref_prop)."""
    probs = ", ".join(f"{i}e-1" if n_bins == 10 else repr(i / n_bins) for i in range(1, n_bins))
    return [
        ("blong", long_sql(base, features, False)),
        ("edges", f"SELECT feature, class, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS edges "
                  "FROM blong GROUP BY feature, class"),
        ("bcnt", "SELECT l.feature, l.class, CAST(len(list_filter(e.edges, lambda z: z <= l.value)) AS BIGINT) "
                 "AS bin, count(*) AS n FROM blong l JOIN edges e USING (feature, class) GROUP BY ALL"),
        ("bgrid", "SELECT feature, class, edges, unnest(range(0, len(edges) + 1)) AS bin FROM edges"),
        ("bins", """SELECT g.feature, g.class, CAST(g.bin AS BIGINT) AS bin,
  CASE WHEN g.bin = 0 THEN CAST('-inf' AS DOUBLE) ELSE g.edges[g.bin] END AS lo,
  CASE WHEN g.bin = len(g.edges) THEN CAST('inf' AS DOUBLE) ELSE g.edges[g.bin + 1] END AS hi,
  coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY g.feature, g.class) AS ref_prop
FROM bgrid g LEFT JOIN bcnt c ON c.feature = g.feature AND c.class = g.class AND c.bin = g.bin"""),
    ]


def monitor_ctes(src: str, features: list[str], kind: str = "psi") -> list[tuple[str, str]]:
    """src: CTE with (class, period, features...) -> scored(period, feature, class, <kind>, status)."""
    feats = ", ".join(f"({q(f)})" for f in features)
    return [
        ("clong", long_sql(src, features, True)),
        ("cells", f"SELECT DISTINCT s.class, s.period, f.feature FROM {src} s, (VALUES {feats}) f(feature)"),
        ("ccnt", "SELECT l.feature, l.class, l.period, "
                 "CAST(len(list_filter(e.edges, lambda z: z <= l.value)) AS BIGINT) AS bin, count(*) AS n "
                 "FROM clong l JOIN edges e USING (feature, class) GROUP BY ALL"),
        ("dense", """SELECT c.feature, c.class, c.period, b.bin, b.ref_prop, coalesce(k.n, 0) AS n,
  sum(coalesce(k.n, 0)) OVER (PARTITION BY c.feature, c.class, c.period) AS total
FROM cells c JOIN bins b ON b.feature = c.feature AND b.class = c.class
LEFT JOIN ccnt k ON k.feature = c.feature AND k.class = c.class AND k.period = c.period AND k.bin = b.bin"""),
        ("scored", f"""SELECT period, feature, class,
  CASE WHEN max(total) > 0 THEN sum({term('CASE WHEN total > 0 THEN n / total END', 'ref_prop', kind)}) END
    AS {kind},
  CASE WHEN max(total) > 0 THEN 'ok' ELSE 'no_data' END AS status
FROM dense GROUP BY period, feature, class
UNION ALL
SELECT period, feature, class, CAST(NULL AS DOUBLE) AS {kind}, 'no_baseline' AS status
FROM cells c WHERE NOT EXISTS (SELECT 1 FROM bins b WHERE b.feature = c.feature AND b.class = c.class)"""),
    ]


def predicted_ctes(base: str, src: str) -> list[tuple[str, str]]:
    """base/src have a ``pred`` column; src has ``period`` -> pscored(period, feature, class, psi, status)."""
    return [
        ("pref", "SELECT class, n / sum(n) OVER () AS ref FROM (SELECT CAST(pred AS VARCHAR) AS class, "
                 f"count(*) AS n FROM {base} WHERE pred IS NOT NULL GROUP BY 1) t"),
        ("pcnt", f"SELECT period, CAST(pred AS VARCHAR) AS class, count(*) AS n FROM {src} GROUP BY ALL"),
        ("pgrid", f"""SELECT p.period, r.class, r.ref, coalesce(c.n, 0) AS n
FROM (SELECT DISTINCT period FROM {src}) p CROSS JOIN pref r
LEFT JOIN pcnt c ON c.period = p.period AND c.class = r.class"""),
        ("punseen", f"""SELECT period, 1 - count(*) FILTER (WHERE CAST(pred AS VARCHAR) IN (SELECT class FROM pref)) / count(*)
  AS unseen_share FROM {src} GROUP BY period"""),
        ("pscored", f"""SELECT period, '__predicted_class_balance__' AS feature, '__all__' AS class,
  sum({term('comp', 'ref')}) AS psi, 'ok' AS status
FROM (SELECT *, coalesce(n / nullif(sum(n) OVER (PARTITION BY period), 0), 0) AS comp FROM pgrid) t
GROUP BY period"""),
    ]
