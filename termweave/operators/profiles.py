"""Semantic profiles of documents: mean vectors of their terms, and the best types."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: The semantic types in the order of a vector's positions.
SEMANTIC_TYPES = (
    "aapp", "acab", "acty", "aggp", "alga", "amph", "anab", "anim", "anst", "antb", "arch", "bacs", "bact", "bdsu", "bdsy", "bhvr",
    "biof", "bird", "blor", "bmod", "bodm", "bpoc", "bsoj", "carb", "celc", "celf", "cell", "cgab", "chem", "chvf", "chvs", "clas",
    "clna", "clnd", "cnce", "comd", "diap", "dora", "dsyn", "edac", "eehu", "eico", "elii", "emod", "emst", "enzy", "evnt", "famg",
    "ffas", "fish", "fndg", "fngs", "food", "ftcn", "genf", "geoa", "gngm", "gora", "grpa", "grup", "hcpp", "hcro", "hlca", "hops",
    "horm", "humn", "idcn", "imft", "inbe", "inch", "inpo", "inpr", "invt", "irda", "lang", "lbpr", "lbtr", "lipd", "mamm", "mbrt",
    "mcha", "medd", "menp", "mnob", "mobd", "moft", "neop", "nnon", "npop", "nsba", "nusq", "ocac", "ocdi", "opco", "orch", "orga",
    "orgf", "orgm", "orgt", "ortf", "patf", "phob", "phpr", "phsf", "phsu", "plnt", "podg", "popg", "prog", "qlco", "qnco", "rcpt",
    "rept", "resa", "resd", "rich", "rnlw", "sbst", "shro", "socb", "sosy", "spco", "strd", "tisu", "tmco", "topp", "virs", "vita",
    "vtbt",
)


def term_frequencies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, term, tf): upper-cased terms between signs and white space."""
    x = docs.select(F.col(id_col).alias("doc_id"), F.explode(T.delimited_terms(F.col(text_col))).alias("t"))
    return x.select("doc_id", F.upper("t").alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def allowed(tf: DataFrame, allow: DataFrame, stop: DataFrame) -> DataFrame:
    """Terms in the allow list and not in the stop list; lists are (word) and count as they are written."""
    return tf.join(allow.select(F.col("word").alias("term")).distinct(), "term", "left_semi").join(stop.select(F.col("word").alias("term")).distinct(), "term", "left_anti")


def profile_sums(tf: DataFrame, vectors: DataFrame, docs_per_block: int = 50_000) -> DataFrame:
    """(doc_id, n, sums array<bigint>): occurrences with a vector, and sums over them; documents without any have no row.

    A product of two matrices in blocks of documents.  A term and the documents of a block that have it are one row, so a vector
    travels once for each term and block, not for each document; a very frequent term is as many rows as there are blocks, each with
    a bounded list.  A block's rows meet in one task, which adds them up as they come: it holds the sums of its documents and a batch.
    Null components count as zero; vectors must all be as long as there are types.
    """
    spark, k = tf.sparkSession, len(SEMANTIC_TYPES)
    found = tf.agg(F.approx_count_distinct("doc_id")).first()[0]
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found // docs_per_block))
    kind = tf.schema["doc_id"].dataType.simpleString()
    # Dealt by term once: what follows groups and joins without another shuffle of the counts.
    by_term = tf.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("b"), "term", "doc_id", "tf").repartition("term")
    x = by_term.groupBy("term", "b").agg(F.collect_list(F.struct("doc_id", F.col("tf").cast("bigint").alias("tf"))).alias("docs"))
    x = x.join(vectors.select("term", F.col("vec").cast("array<int>").alias("vec")), "term").select("b", "vec", "docs").repartition(blocks, "b").sortWithinPartitions("b")

    def add_up(batches):
        import numpy as np
        import pyarrow as pa

        def result(ids, sums):
            n = len(ids)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(sums[:n, :k].ravel()))
            return pa.RecordBatch.from_arrays([pa.array(list(ids), id_type), pa.array(sums[:n, k]), lists], names=["doc_id", "n", "sums"])

        block, ids, sums, id_type = None, {}, np.zeros((0, k + 1), np.int64), None
        for batch in batches:
            of = batch.column(0).to_numpy()
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(of)) + 1):
                if not len(part):
                    continue
                if of[part[0]] != block:
                    if ids:
                        yield result(ids, sums)
                    block, ids, sums = of[part[0]], {}, np.zeros((256, k + 1), np.int64)
                rows = batch.slice(int(part[0]), len(part))
                vec, docs = rows.column(1), rows.column(2)
                v = np.ones((len(part), k + 1), np.int64)  # the last column counts
                v[:, :k] = vec.flatten().fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, k)
                flat, term = docs.flatten(), np.repeat(np.arange(len(part)), docs.value_lengths().to_numpy())
                code = flat.field(0).dictionary_encode()
                id_type = code.type.value_type
                place = np.array([ids.setdefault(i, len(ids)) for i in code.dictionary.to_pylist()], np.int64)
                if len(ids) > len(sums):
                    sums = np.concatenate((sums, np.zeros((max(len(sums), len(ids) - len(sums)), k + 1), np.int64)))
                row, times = place[code.indices.to_numpy()], flat.field(1).to_numpy()
                order = np.argsort(row, kind="stable")
                for i in range(0, len(order), 8192):
                    some = order[i : i + 8192]
                    at, starts = np.unique(row[some], return_index=True)
                    sums[at] += np.add.reduceat(v[term[some]] * times[some, None], starts, axis=0)
        if ids:
            yield result(ids, sums)

    return x.mapInArrow(add_up, f"doc_id {kind}, n long, sums array<bigint>")


def truncated_mean(total: Column, n: Column) -> Column:
    """total / n towards zero."""
    return ((total - total % n) / n).cast("long")


def profiles(docs: DataFrame, sums: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, profile): mean vectors, all zeros for documents without a term that has a vector."""
    zeros = F.array_repeat(F.lit(0).cast("long"), len(SEMANTIC_TYPES))
    x = docs.select(F.col(id_col).alias("doc_id")).distinct().join(sums, "doc_id", "left")
    return x.select("doc_id", F.when(F.col("n").isNull(), zeros).otherwise(F.transform("sums", lambda s: truncated_mean(s, F.col("n")))).alias("profile"))


def by_type(prof: DataFrame) -> DataFrame:
    """(doc_id, pos, semtype, score)."""
    names = F.array(*[F.lit(t) for t in SEMANTIC_TYPES])
    return prof.select("doc_id", F.posexplode("profile").alias("pos", "score")).withColumn("semtype", F.get(names, F.col("pos")))


def score_map(prof: DataFrame) -> DataFrame:
    """(doc_id, score, semtype): one row a distinct score, with the last position that has it."""
    return by_type(prof).groupBy("doc_id", "score").agg(F.max_by("semtype", "pos").alias("semtype"))


def top_types(prof: DataFrame, n: int = 10) -> DataFrame:
    """(doc_id, rank, semtype, score decimal(18,4)): the n best distinct scores, in units of a ten-thousandth; within a document's own array, without a shuffle."""
    names = F.array(*[F.lit(t) for t in SEMANTIC_TYPES])
    ranked = F.slice(F.reverse(F.array_sort(F.zip_with("profile", F.sequence(F.lit(0), F.lit(len(SEMANTIC_TYPES) - 1)), lambda s, p: F.struct(s.alias("score"), p.alias("pos"))))), 1, len(SEMANTIC_TYPES))
    # Descending by score, then position: the first of each score has its last position.  The one-element array sorts only once.
    first = lambda r: F.filter(r, lambda e, i: (i == 0) | (F.get(r, i - 1)["score"] != e["score"]))
    x = prof.select("doc_id", F.slice(F.transform(F.array(ranked), first)[0], 1, n).alias("r"))
    x = x.select("doc_id", F.posexplode("r").alias("k", "e"))
    return x.select("doc_id", (F.col("k") + 1).alias("rank"), F.get(names, F.col("e.pos")).alias("semtype"), (F.col("e.score").cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(18,4)").alias("score"))


def best_type(prof: DataFrame) -> DataFrame:
    """(doc_id, semtype): the first position of the greatest score if that is above zero, else null."""
    most = F.array_max("profile")
    names = F.array(*[F.lit(t) for t in SEMANTIC_TYPES])
    return prof.select("doc_id", F.when(most > 0, F.get(names, (F.array_position(F.col("profile"), most) - 1).cast("int"))).alias("semtype"))


def scores_by_type(prof: DataFrame) -> DataFrame:
    """(doc_id, scores): a document's scores as a map from semantic type, types descending."""
    names = F.array(*[F.lit(t) for t in sorted(SEMANTIC_TYPES, reverse=True)])
    at = F.array(*[F.lit(SEMANTIC_TYPES.index(t)) for t in sorted(SEMANTIC_TYPES, reverse=True)])
    return prof.select("doc_id", F.map_from_arrays(names, F.transform(at, lambda i: F.get("profile", i))).alias("scores"))


def display_lines(top: DataFrame) -> DataFrame:
    """(doc_id, rank, value): `type|score` lines, best first within a document."""
    return top.select("doc_id", "rank", F.concat_ws("|", "semtype", "score").alias("value"))


# The function travels with the query, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
