"""Readers of the text formats: term tables, word pairs, word sets, lexicon records, vectors, paragraphs, documents, configuration, import lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

TERM_FIELDS = ("cui", "lat", "ts", "lui", "stt", "sui", "ispref", "aui", "saui", "scui", "sdui", "sab", "tty", "code", "str", "srl", "suppress", "cvf")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no long, value): the lines of one file or folder; numbers grow with the order of lines and leave gaps between splits."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value")


def parse_terms(lines: DataFrame, strict: bool = True) -> DataFrame:
    """(line_no, line, 18 fields): empty lines are skipped; another number of fields is an error if strict, else fewer than 18 are dropped."""
    x = lines.where(F.length("value") > 0).withColumn("f", T.parse_record(F.col("value")))
    n = F.size("f")
    if strict:
        bad = F.raise_error(F.concat(F.lit("not 18 fields: "), F.col("value"))).cast("array<string>")
        x = x.withColumn("f", F.when(n == len(TERM_FIELDS), F.col("f")).otherwise(bad))
    else:
        x = x.where(n >= len(TERM_FIELDS))
    return x.select("line_no", F.col("value").alias("line"), *[F.col("f")[i].alias(c) for i, c in enumerate(TERM_FIELDS)])


def read_terms(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_terms(numbered_lines(spark, path), strict)


def parse_pairs(lines: DataFrame) -> DataFrame:
    """(first, last) word pairs; a line without exactly two fields is an error."""
    x = lines.withColumn("f", F.split("value", "[|]", -1))
    f = F.when(F.size("f") == 2, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("not a pair: "), F.col("value"))).cast("array<string>"))
    return x.select(f.alias("f")).select(F.col("f")[0].alias("first"), F.col("f")[1].alias("last"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return parse_pairs(spark.read.text(path))


def word_set(lines: DataFrame) -> DataFrame:
    """(word): distinct words of a word list; numbers, quoted text and slash comments are not words."""
    plain = F.regexp_replace(F.regexp_replace("value", "/.*$", ""), "\"[^\"]*\"?|'[^']*'?", " ")
    return lines.select(F.explode(F.regexp_extract_all(plain, F.lit(r"([A-Za-z -￿][^\s]*)"))).alias("word")).distinct()


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(value): one record a row; a record ends at a line that is exactly a closing brace, braces within lines do not end it."""
    return spark.read.option("lineSep", "\n}\n").text(path).where(F.length(F.trim("value")) > 0)


def parse_lexicon(records: DataFrame, *keep: str) -> DataFrame:
    """(eui, base, fields map<string, array<string>>), and the columns to keep, of records without their closing brace.

    A record without base or entry is an error that names what its first line holds.
    """
    lines = F.split(F.regexp_replace(F.regexp_replace("value", r"(\n\})?\s*$", ""), r"^\s*\{", ""), "\n")
    pairs = F.transform(F.filter(lines, lambda s: F.trim(s) != ""), lambda s: F.struct(F.substring_index(F.trim(F.translate(s, "\t", " ")), "=", 1).alias("k"), F.regexp_replace(s, "^[^=]*=?", "").alias("v")))
    x = records.withColumn("p", pairs)
    keys = F.array_distinct(F.transform("p", lambda p: p["k"]))
    fields = F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(F.filter("p", lambda p: p["k"] == k), lambda p: p["v"])))
    x = x.withColumn("fields", fields)
    bad = F.raise_error(F.concat(F.lit("no lexical record: "), F.regexp_extract("value", r"^\{?base=([^\n]*)", 1)))
    eui = F.when(F.map_contains_key("fields", "entry") & F.map_contains_key("fields", "base"), F.col("fields")["entry"][0]).otherwise(bad)
    return x.select(*keep, eui.alias("eui"), F.col("fields")["base"][0].alias("base"), "fields")


def lexicon_lines(parsed: DataFrame, *keep: str) -> DataFrame:
    """(eui, value), and the columns to keep: `EUI|record` with the record as JSON."""
    return parsed.select(*keep, "eui", F.concat_ws("|", "eui", F.to_json(F.struct("base", "fields"))).alias("value"))


def term_list(lines: DataFrame) -> DataFrame:
    """(line_no, term): one term a line; empty lines are skipped."""
    return lines.where(F.length("value") > 0).select("line_no", F.col("value").alias("term"))


def read_term_list(spark: SparkSession, path: str) -> DataFrame:
    return term_list(numbered_lines(spark, path))


def stop_phrases(lines: DataFrame) -> DataFrame:
    """(phrase): one phrase a line, each once."""
    return lines.select(F.col("value").alias("phrase")).distinct()


def read_stop_phrases(spark: SparkSession, path: str) -> DataFrame:
    return stop_phrases(spark.read.text(path))


def joined_lines(text: Column) -> Column:
    """The lines of a whole text, with a blank after each."""
    return F.concat(F.regexp_replace(F.regexp_replace(text, r"\r?\n$", ""), r"\r?\n", " "), F.lit(" "))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): each file as one document, its lines joined with a blank after each."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), joined_lines(F.col("value")).alias("text"))


#: Keys of the configuration and what they are where it leaves them out.
CONFIGURATION = {"DISAMB_SERVER_STI_INDEXPATH": "wstv-dc", "DISAMB_SERVER_STI_RESTRICTWORDSFILE": "restrictwords.txt", "DISAMB_SERVER_STI_STOPWORDSFILE": "stopwords.txt"}


def read_configuration(spark: SparkSession, path: str) -> dict[str, str]:
    """`key=value` or `key: value` lines of a configuration file over the defaults; lines that open with # or ! are comments."""
    lines = spark.read.text(path).where(~F.trim("value").rlike("^[#!]")).select(F.regexp_extract("value", r"^\s*([^=:\s]+)\s*[=:\s]\s*(.*?)\s*$", 1).alias("k"), F.regexp_extract("value", r"^\s*([^=:\s]+)\s*[=:\s]\s*(.*?)\s*$", 2).alias("v"))
    return CONFIGURATION | {r.k: r.v for r in lines.where("k <> ''").collect()}  # a few lines


def load_vectors(lines: DataFrame, order: str = "line_no") -> DataFrame:
    """(term, vec array<int>) of lines `KEY c1 c2 ...`; of a repeated key the last line counts; empty lines are skipped."""
    x = lines.where(F.length(F.trim("value")) > 0).withColumn("f", F.split(F.trim("value"), " +"))
    x = x.select(F.col("f")[0].alias("term"), F.slice("f", 2, F.size("f") - 1).cast("array<int>").alias("vec"), order)
    return x.groupBy("term").agg(F.max_by("vec", order).alias("vec"))


def write_vectors(vectors: DataFrame, path: str) -> None:
    """By length of the term, sorted within: readers of one term skip all other lengths."""
    x = vectors.withColumn("term_len", F.length("term"))
    x.repartition("term_len", F.pmod(F.xxhash64("term"), F.lit(16))).sortWithinPartitions("term_len", "term").write.partitionBy("term_len").mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str, term: str | None = None) -> DataFrame:
    x = spark.read.parquet(path)
    return x if term is None else x.where((F.col("term_len") == len(term)) & (F.col("term") == term))


def index_statistics(lines: DataFrame) -> DataFrame:
    """(term_len, terms, lines): distinct keys and lines of each length."""
    x = lines.where(F.length(F.trim("value")) > 0).select(F.split(F.trim("value"), " +")[0].alias("term"))
    return x.groupBy("term").agg(F.count("*").alias("n")).groupBy(F.length("term").alias("term_len")).agg(F.count("*").alias("terms"), F.sum("n").alias("lines"))


def paragraphs(texts: DataFrame, *keep: str) -> DataFrame:
    """(text), and the columns to keep: paragraphs that an empty line ends; single line ends become blanks, leading white space goes; unended text is dropped."""
    parts = F.split("value", "\n\n", -1)
    x = texts.select(*keep, F.explode(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("p"))
    return x.select(*keep, F.regexp_replace(F.translate("p", "\n", " "), r"^[ \t\n]+", "").alias("text")).where("text <> ''")


def read_paragraphs(spark: SparkSession, path: str) -> DataFrame:
    return paragraphs(spark.read.text(path, wholetext=True))


def import_list(lines: DataFrame, path: str = "path", order: str = "line_no") -> DataFrame:
    """(predicate, arity, module), each once: what the import directives of source files name, save those of libraries.

    A directive names a compound module and a list of name/arity; comments run to the end of a line.  A source file is gathered
    into one string, as sources are short.
    """
    plain = F.regexp_replace("value", "%.*", "")
    source = lines.groupBy(path).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("n"), plain.alias("v")))), lambda l: l["v"]), "\n").alias("source"))
    directive = r":-\s*use_module\(\s*(\w+\([^()]*\))\s*,\s*\[([^\]]*)\]"
    each = source.select(F.explode(F.regexp_extract_all("source", F.lit(directive), F.lit(0))).alias("d"))
    each = each.select(F.regexp_replace(F.regexp_extract("d", directive, 1), r"\s+", "").alias("module"), F.explode(F.regexp_extract_all(F.regexp_extract("d", directive, 2), F.lit(r"(\w+/\d+)"))).alias("item"))
    each = each.where(~F.startswith("module", F.lit("library(")))
    return each.select(F.substring_index("item", "/", 1).alias("predicate"), F.substring_index("item", "/", -1).cast("int").alias("arity"), "module").distinct()
