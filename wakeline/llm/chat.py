"""Chat formatting after cumulative-snapshot collapse.

A conversation that was logged after each turn appears several times, each log
a prefix of the next.  The turns of a conversation, in order, have rolling
hashes: the hash after turn i is the sum, over turns 0 to i, of two 64-bit
hashes of (place, role, text), so it stands for the whole prefix.  A logged
conversation goes if its last hash is the hash of a proper prefix of another
(anti-join), or if an equal conversation has a smaller id.  The maximal ones
that stay are rendered as

    <|im_start|>role\\ntext<|im_end|>\\n   per turn.

Only DataFrame functions are used.  Places and rolling hashes come from
distributed prefix sums (``range_sorted``, ``prefix_sum``), so one conversation
may hold any share of the turns; equal conversations meet in one row before the
anti-join.  A conversation is written in parts of ``PART`` turns, one row each,
in order: nearly all have one, and no row gathers more turns than that.

Cases: turns are ordered by turn, role and text, nulls first; places do not
depend on the numbering.  A null role or text differs from an empty one when
compared and is rendered as empty.  All rows with a null conv_id are one
conversation.  Repeated rows are turns of their own.  A text may spell the
marks themselves: every ``<|`` in a role or text is written ``<\\|``, and a line
end in a role is a space, so no turn can begin or end another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, prefix_sum, range_sorted

PART = 256


def _turn_hash(salt: str) -> Column:
    """A hash of place, role and text as a decimal, whose sums don't overflow."""
    parts = [F.lit(salt), F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return F.xxhash64(*parts).cast("decimal(20,0)")


def rolling(turns: DataFrame) -> DataFrame:
    """conv_id, role, text, place (from 0) and the prefix hashes h1, h2."""
    order = ["turn", "role", "text"]
    ranged = range_sorted(turns.select("conv_id", *order), ["conv_id"], order, "turns")
    placed = materialize(prefix_sum(ranged, ["conv_id"], order, F.lit(1), "place"), "placed")
    for name in ("h1", "h2"):
        placed = prefix_sum(placed, ["conv_id"], ["place"], _turn_hash(name), name)
        placed = placed.withColumn(name, (F.col(name) + _turn_hash(name)).cast("decimal(38,0)"))
    return materialize(placed.select("conv_id", "role", "text", "place", "h1", "h2"), "rolling")


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_logs (equal logs) of the conversations that stay."""
    last = (prefixes.groupBy("conv_id").agg(F.max(F.struct("place", "h1", "h2")).alias("last"))
            .select("conv_id", "last.*"))
    distinct = (last.groupBy("place", "h1", "h2")
                .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_logs")))
    length = last.select(F.col("conv_id").alias("_of"), F.col("place").alias("_last"))
    proper = (prefixes.join(length, F.col("conv_id").eqNullSafe(F.col("_of")))
              .where(F.col("place") < F.col("_last")).select("place", "h1", "h2").distinct())
    return (distinct.join(proper, ["place", "h1", "h2"], "left_anti")
            .select("conv_id", (F.col("place") + 1).alias("n_turns"), "n_logs"))


def _inert(text: Column) -> Column:
    """No mark can be read in it."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, n_logs and text of every maximal conversation."""
    prefixes = rolling(turns)
    kept = materialize(maximal(prefixes), "maximal").withColumnRenamed("conv_id", "_kept")
    piece = F.concat(F.lit("<|im_start|>"), F.translate(_inert(F.col("role")), "\r\n", "  "), F.lit("\n"),
                     _inert(F.col("text")), F.lit("<|im_end|>\n"))
    part = F.floor(F.col("place") / PART).cast("int")
    return (prefixes.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept")))
            .groupBy("conv_id", part.alias("part"))
            .agg(F.first("n_turns").alias("n_turns"), F.first("n_logs").alias("n_logs"),
                 F.sort_array(F.collect_list(F.struct("place", piece.alias("piece")))).alias("pieces"))
            .select("conv_id", "part", "n_turns", "n_logs", F.array_join("pieces.piece", "").alias("text")))


CHAT_SQL = r"""
WITH placed AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place
  FROM conversations),
prefixes AS (
  SELECT conv_id, place, role, text,
         string_agg(coalesce('r' || role, '-') || chr(1) || coalesce('t' || text, '-') || chr(2), '')
           OVER (PARTITION BY conv_id ORDER BY place) AS prefix
  FROM placed),
last AS (
  SELECT conv_id, max(place) AS place, arg_max(prefix, place) AS prefix FROM prefixes GROUP BY conv_id),
kept AS (
  SELECT min(conv_id) AS conv_id, place + 1 AS n_turns, count(*) AS n_logs
  FROM last l
  WHERE NOT EXISTS (SELECT 1 FROM prefixes p JOIN last o ON p.conv_id IS NOT DISTINCT FROM o.conv_id
                    WHERE p.place < o.place AND p.place = l.place AND p.prefix = l.prefix)
  GROUP BY place, prefix)
SELECT k.conv_id, CAST(p.place // 256 AS INTEGER) AS part, any_value(n_turns) AS n_turns, any_value(n_logs) AS n_logs,
       string_agg('<|im_start|>' || translate(replace(coalesce(role, ''), '<|', '<\|'), chr(13) || chr(10), '  ') || chr(10)
         || replace(coalesce(text, ''), '<|', '<\|') || '<|im_end|>' || chr(10), '' ORDER BY p.place) AS text
FROM kept k JOIN prefixes p ON k.conv_id IS NOT DISTINCT FROM p.conv_id
GROUP BY k.conv_id, p.place // 256
"""
