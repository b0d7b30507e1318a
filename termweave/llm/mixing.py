"""Mixing sources to target weights by weighted sampling without replacement, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, text_or_empty

#: Weights of the sources in order of code points, null last, repeating; a source gives at most so many times its size.
WEIGHTS, MOST_EPOCHS = (5, 2, 1), 3
SEED = "mix-1"
#: Sources that are broadcast at most (a row of under 100 bytes each), salts beyond that, bins a round, and rows of a source sorted at the end.
BROADCAST_SOURCES, SALTS, BINS, FEW_ROWS = 50_000, 64, 1024, 2_000


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality_weight(size: Column, column: str = "text") -> Column:
    """A document's weight, 0.1 to 1: 1 at six characters a word with its blank, less the further its words are from that."""
    per_word = F.length(text_or_empty(column)) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), 1.0 - F.abs(per_word - 6.0) / 1.5))


def sampling_key(doc_id: str, weight: Column) -> Column:
    """-ln(u) / weight for u from the id: exponential with the weight as its rate, so the least keys are a weighted sample."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(SEED), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary")), 1, 12), 16, 10).cast("double")
    return -F.ln((bits + 1.0) / 281474976710657.0) / weight


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """sizes: (src, source_size, n); adds target double.

    All sizes together are shared by weight; a source at `most` times its size stops there and the others share the rest by weight.
    So targets are the lesser of that stop and level * weight; sources are taken in order of stop / weight, and the level is
    what is left over the weight that is left.  One row a source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    by = Window.orderBy("ratio", "rank")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(0, Window.unboundedFollowing)
    all_of = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = sizes.withColumn("rank", rank).withColumn("w", w).withColumn("stop", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("stop") / F.col("w"))
    x = x.withColumn("level", (F.sum("source_size").over(all_of) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    # Stops come first as long as they are below the level; the first that is not sets the level of all that follow.
    x = x.withColumn("final", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "rank", "level"))).over(all_of))
    return x.withColumn("target", F.when(F.col("final").isNull() | (F.struct("ratio", "rank") < F.struct("final.ratio", "final.rank")), F.col("stop")).otherwise(F.col("final.level") * F.col("w"))).drop("rank", "w", "stop", "ratio", "level", "final")


def _with_source(rows: DataFrame, per_source: DataFrame, own: str, theirs: str) -> DataFrame:
    """rows joined with one row a source: broadcast while those are few, else dealt by source and salt; no source meets in one task.

    per_source must be cheap to read twice.  With many sources each of its rows is sent to SALTS places, and a source's rows are spread over them.
    """
    same = F.col(own).eqNullSafe(F.col(theirs))
    if per_source.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(per_source), same)
    left, right = rows.withColumn("salt", F.pmod(F.xxhash64("id", "key"), F.lit(SALTS))), per_source.withColumn("psalt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, same & (F.col("salt") == F.col("psalt"))).drop("salt", "psalt")


def _plan(rows: DataFrame, weights, most) -> DataFrame:
    """rows: (src, id, size, weight, key).  For each source: source_size, target, epochs, and where the fraction ends: lo, last_key, last_id.

    Where a source's running sum in order of keys crosses its budget is found by halving in: each round deals the keys that are
    still in question into bins, sums those, and goes on within the bin that crosses, until it holds few rows or one key.  So a
    source of any size, with keys of any distribution, is never sorted in one task; at the end few rows a source are.
    """
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    t = source_targets(sizes, weights, most)
    t = t.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    t = durable(t.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))
    at = t.where("budget > 0").select(F.col("src").alias("csrc"), "budget", "lo", "hi", "n", F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("before"))
    while True:
        left = at.where((F.col("n") > FEW_ROWS) & (F.col("lo") < F.col("hi")))
        if left.isEmpty():
            break
        inside = _with_source(rows, left, "src", "csrc").where((F.col("key") >= F.col("lo")) & (F.col("key") <= F.col("hi")))
        bin_ = F.least(F.floor((F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
        sums = inside.groupBy("csrc", "budget", F.col("base").alias("b0"), F.col("before").alias("n0"), bin_.alias("bin")).agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        upto = Window.partitionBy("csrc").orderBy("bin")
        sums = sums.withColumn("upto", F.col("b0") + F.sum("s").over(upto)).withColumn("rows_upto", F.col("n0") + F.sum("n").over(upto))
        finer = sums.where("upto >= budget and upto - s < budget").select("csrc", "budget", "lo", "hi", "n", (F.col("upto") - F.col("s")).alias("base"), (F.col("rows_upto") - F.col("n")).alias("before"))
        at = durable(finer.unionByName(at.where((F.col("n") <= FEW_ROWS) | (F.col("lo") >= F.col("hi")))))
    inside = _with_source(rows, at, "src", "csrc").where((F.col("key") >= F.col("lo")) & (F.col("key") <= F.col("hi")))
    # Rows that tie in key and id are taken together, and meet as one.
    inside = inside.groupBy("csrc", "budget", "base", "before", "lo", "key", "id").agg(F.sum("size").alias("size"))
    run = inside.withColumn("upto", F.col("base") + F.sum("size").over(Window.partitionBy("csrc").orderBy("key", "id")))
    # The document that crosses the budget is taken if that comes nearer to it than leaving it.
    near = F.min(F.struct(F.abs(F.col("upto") - F.col("budget")).alias("d"), "upto", "key", "id")).alias("at")
    last = run.groupBy("csrc", "base", "before", "budget", "lo").agg(near)
    gap = F.col("budget") - F.col("base")
    some = (F.col("at.d") < gap) | ((F.col("at.d") == gap) & (F.col("before") == 0))
    last = last.select("csrc", "lo", F.when(some, F.col("at.key")).alias("last_key"), F.when(some, F.col("at.id")).alias("last_id"))
    return durable(t.drop("lo").join(last, F.col("src").eqNullSafe(F.col("csrc")), "left").select(F.col("src").alias("psrc"), "source_size", "target", "epochs", "lo", "last_key", "last_id"))


def _copies() -> Column:
    upto_last = F.struct("key", "id") <= F.struct(F.col("last_key"), F.col("last_id"))
    return F.col("epochs") + F.coalesce((F.col("key") < F.col("lo")) | (F.col("last_key").isNotNull() & upto_last), F.lit(False)).cast("long")


def _rows(docs: DataFrame, id_col: str, source_col: str, text_col: str, weight) -> DataFrame:
    size = word_count(text_col)
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.col(source_col).cast("string").alias("src"), size.alias("size"), F.col(text_col).alias("text"))
    x = x.withColumn("weight", (weight or quality_weight)(F.col("size"))).drop("text")
    return x.withColumn("key", sampling_key("doc_id", F.col("weight")))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weight=None) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) for each row of docs: how many words of it the mix takes.

    weight: a function from the size column to a document's weight, which may read the column text; quality_weight if None.
    A source is taken whole as often as its target allows; the rest is a weighted sample, in order of exponential keys, up to the
    document whose end is nearest to the budget.  Rows equal in source and id share a key and are taken or left together; a null
    source is one more source, a null text has size 0, a null id counts as the least; an empty table gives none.  Whole texts of any
    length are counted within their rows.  Columns of docs are read by name and never meet with those made here.
    """
    rows = durable(_rows(docs, id_col, source_col, text_col, weight))
    p = _plan(rows, weights, most)
    x = _with_source(rows, p, "src", "psrc").withColumn("copies", _copies())
    return x.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weight=None) -> DataFrame:
    """The rows of docs as often as the mix takes them, with all their columns, whatever their names.

    The plan, one row a source, is broadcast while sources are few, and then no text is shuffled; beyond BROADCAST_SOURCES rows
    move by source and salt.  Nulls, empty texts, ties, repeated rows and empty tables count as in mix.
    """
    rows = durable(_rows(docs, id_col, source_col, text_col, weight))
    p = _plan(rows, weights, most)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")  # the only column, so names cannot clash
    x = docs.select(own)
    at = lambda c: F.col(f"__row.`{c}`")
    x = x.withColumn("src", at(source_col).cast("string")).withColumn("doc_id", at(id_col).cast("long")).withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("text", at(text_col))
    x = x.withColumn("size", word_count("text")).withColumn("weight", (weight or quality_weight)(F.col("size"))).withColumn("key", sampling_key("doc_id", F.col("weight")))
    x = _with_source(x, p, "src", "psrc")
    return x.select("__row", F.explode(F.array_repeat(F.lit(0), _copies().cast("int")))).select("__row.*")


#: The same rows by DuckDB.
SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, length(coalesce(text, '')) AS chars FROM documents
), k AS (
  SELECT *, coalesce(doc_id, -9223372036854775808) AS id,
    -ln((('0x' || substr(md5('mix-1' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT::DOUBLE + 1.0) / 281474976710657.0)
      / greatest(0.1::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - abs(chars::DOUBLE / greatest(size, 1) - 6.0::DOUBLE) / 1.5::DOUBLE)) AS key
  FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source
), w AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 3.0::DOUBLE * source_size AS stop FROM s
), l AS (
  SELECT *, stop / w AS ratio, ((SELECT sum(source_size) FROM s)::DOUBLE
      - coalesce(sum(stop) OVER (ORDER BY stop / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
    / sum(w) OVER (ORDER BY stop / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), f AS (
  SELECT *, (SELECT min(ratio) FROM l WHERE ratio > level) AS fratio, (SELECT level FROM l WHERE ratio > level ORDER BY ratio, rank LIMIT 1) AS flevel FROM l
), t AS (
  SELECT source, source_size, CASE WHEN fratio IS NULL OR ratio < fratio THEN stop ELSE flevel * w END AS target FROM f
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t
), r AS (
  SELECT k.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY key, id) AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
), n AS (
  SELECT *, min(abs(upto - budget)) OVER (PARTITION BY source) AS d FROM r
), c AS (
  SELECT *, min(CASE WHEN abs(upto - budget) = d THEN upto END) OVER (PARTITION BY source) AS last FROM n
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + CASE WHEN budget > 0 AND d <= budget AND upto <= last THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
