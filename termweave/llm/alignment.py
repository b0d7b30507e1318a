"""Two tokenizers' tokens of the same text, aligned by bitsets of their ends, and how often ids meet across a corpus."""

from __future__ import annotations

import hashlib
import re
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_pairs
from .common import durable, fresh, remove, shared_dir, worker_cache
from .tokens import tokenizer_path

#: The tokenizers of the query: a byte-level .json file (A) and a sentencepiece model (B).
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text taken at once; cells that a worker keeps; different pairs to a block of documents.
PART_BYTES, MOST_CELLS, BLOCK_PAIRS = 2 << 20, 150_000, 300_000
#: Longer cells are encoded one by one.
LONG_CELL = 4096
#: Pairs of ids whose counts are sent to every task, 17 bytes each; beyond it each block of documents gets its own pairs' counts.
LOOKUP_PAIRS = 4_000_000


# Packed bitsets: bit k of word w stands for position 64 w + k.


def bitset(positions, size: int):
    """Words with a bit at each of the positions, all below size; a word more than needed, so that rank may be asked for at the end."""
    import numpy as np

    bits = np.zeros((size // 64 + 1) * 64, np.bool_)
    bits[positions] = True
    return np.packbits(bits, bitorder="little").view("<u8")


def select(words):
    """The positions of all set bits, ascending."""
    import numpy as np

    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def rank(words, positions):
    """How many bits are set below each position: counts of whole words before, and of the word's own lower bits."""
    import numpy as np

    before = np.concatenate(([0], np.cumsum(np.bitwise_count(words).astype(np.int64))))
    w = positions >> 6
    low = (np.uint64(1) << (positions & 63).astype(np.uint64)) - np.uint64(1)
    return before[w] + np.bitwise_count(words[w] & low).astype(np.int64)


def aligned(a_len, b_len, cell_len):
    """Aligns two cuttings of the same bytes.  a_len, b_len: byte lengths of A's and B's tokens; cell_len: of cells, whose ends are ends of both.

    Returns (links, groups): links = (A token, B token, cell) for all overlapping pairs in order, one for each end of the union;
    groups = (first A token, first B token, cell) of the runs between shared ends, the intersection.
    """
    import numpy as np

    size = int(cell_len.sum())
    a, b, cells = (bitset(np.cumsum(x) - 1, size) for x in (a_len, b_len, cell_len))
    ends = select(a | b)
    links = rank(a, ends), rank(b, ends), rank(cells, ends)
    shared = select(a & b)
    begins = np.concatenate(([0], shared[:-1] + 1)) if len(shared) else shared
    return links, (rank(a, begins), rank(b, begins), rank(cells, begins))


class Cells(dict):
    """Cells, runs of text between places where both tokenizers always cut, to what they add to a document.

    A value is (tokens of A, tokens of B, groups, links as keys a * size of B's vocabulary + b in int64, the groups as text);
    the last, with `;` after each group, is None where joined tokens are not the cell's bytes.
    """

    def __init__(self, a_path: str, b_path: str):
        import numpy as np
        import sentencepiece

        super().__init__()
        if not byte_pairs.is_byte_level(a_path):
            raise ValueError(f"{a_path}: not a byte-level vocabulary")
        self.whole, self.ranked = byte_pairs.load(a_path, specials_as_text=True), byte_pairs.ranked_encoder(a_path)
        vocab = self.whole.get_vocab(with_added_tokens=True)
        own = self.whole.get_vocab(with_added_tokens=False)
        raw = {i: byte_pairs.token_bytes(t) if t in own else t.encode() for t, i in vocab.items()}
        self.a_bytes = [raw.get(i, b"") for i in range(max(raw) + 1)]
        b = self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = [bytes([int(s[3:5], 16)]) if b.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(names)]
        self.a_len, self.b_len = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # Ids as they print, with what follows them within a group and at the end of their side of it.
        table = lambda n, end: np.array([f"{i}," for i in range(n)] + [f"{i}{end}" for i in range(n)], object)
        self.a_text, self.b_text = table(len(self.a_bytes), "|"), table(len(names), ";")
        self.b_size = len(names)
        # White space that no piece holds but first, or all in front, is where B cuts whatever stands around it; A always cuts there.
        plain = [s for i, s in enumerate(names) if not b.is_byte(i) and not b.is_control(i)]
        cuts = ["\n", "\t"] if not any(c in s for s in plain for c in "\n\t") else []
        self.separable = bool(cuts) and not any("▁" in s.lstrip("▁") for s in plain)
        white = " \n\t"
        self.simple = re.compile(f"[{white}]+[^{white}]*|[^{white}]+").findall
        self.other_space = re.compile(f"[^\\S{white}]").search
        self.careful = re.compile(f"(?<=\\S)(?=[{white}])").split

    def cut(self, text: str) -> list[str]:
        """The cells of text, a space in front: white space that follows anything else begins one."""
        text = " " + text
        if not self.separable:
            return [text]
        return self.careful(text) if self.other_space(text) else self.simple(text)

    def a_ids(self, cell: str) -> list[int]:
        return self.whole.encode(cell, add_special_tokens=False).ids

    def plain(self, cells: list[str]) -> list[bool]:
        """Which cells may be encoded by A as one text with others of their kind: what follows such a cell is white space, and it ends without."""
        odd = byte_pairs.ODD.search if self.ranked and self.separable else (lambda _: True)
        any_odd = odd("".join(cells))
        return [len(c) <= LONG_CELL and not c[-1].isspace() and not (any_odd and odd(c)) for c in cells]

    def b_ids(self, cells: list[str]) -> list[list[int]]:
        """B's ids of cells within a text: B adds the space that cells of a space and more begin with; others stand behind a line end of their own."""
        lead = [c[:1] == " " and len(c) > 1 for c in cells]
        got = self.b.encode([c[1:] if s else "\n" + c for c, s in zip(cells, lead, strict=True)], num_threads=1)
        return [ids if s else ids[2:] for ids, s in zip(got, lead, strict=True)]

    def learn(self, cells: list[str], keep: dict | None = None) -> None:
        """Adds cells; where there are too many, all go but `keep`."""
        import numpy as np

        if len(self) + len(cells) > MOST_CELLS:
            self.clear()
            if keep and len(keep) + len(cells) <= MOST_CELLS:
                self.update(keep)
        fits = self.plain(cells)
        first = [c for c, f in zip(cells, fits, strict=True) if f]
        others = [c for c, f in zip(cells, fits, strict=True) if not f]
        cells = first + others
        raws = [c.encode() for c in cells]
        lists = self.b_ids(cells)
        count = lambda x: np.fromiter(map(len, x), np.int64, len(x))
        flat = lambda x, n: np.fromiter(chain.from_iterable(x), np.int64, n)
        cell_len, nb = count(raws), count(lists)
        b = flat(lists, int(nb.sum()))
        b_len = self.b_len[b]
        at = np.concatenate(([0], np.cumsum(b_len)))
        b_at = np.concatenate(([0], np.cumsum(nb)))
        right = np.array_equal(np.diff(at[b_at]), cell_len) and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == b"".join(raws)
        if not right:
            bad = {c for c, ids, raw in zip(cells, lists, raws, strict=True) if b"".join([self.b_bytes[i] for i in ids]) != raw}
            self.update(dict.fromkeys(bad, (0, 0, 0, b"", None)))
            return self.learn([c for c in cells if c not in bad]) if len(bad) < len(cells) else None
        a = np.array(self.ranked("".join(first)) if first else [], np.int64)
        rest = [self.a_ids(c) for c in others]
        na_rest = count(rest)
        a = np.concatenate((a, flat(rest, int(na_rest.sum()))))
        a_len = self.a_len[a]
        ends = np.cumsum(cell_len)
        a_at = np.concatenate(([0], np.searchsorted(np.cumsum(a_len), ends) + 1))
        (la, lb, lc), (ga, gb, gc) = aligned(a_len, b_len, cell_len)
        keys = (a[la] * self.b_size + b[lb]).tobytes()
        # The printed ids of a group's A tokens, then of its B tokens, group by group.
        shown = np.empty(len(a) + len(b), object)
        ga, gb = np.append(ga, len(a)), np.append(gb, len(b))
        per_a, per_b = np.diff(ga), np.diff(gb)
        last = lambda x, n: np.bincount(x[1:] - 1, minlength=n).astype(np.int64)  # noqa: E731  1 at the last token of each group
        shown[np.arange(len(a)) + np.repeat(gb[:-1], per_a)] = self.a_text[a + last(ga, len(a)) * len(self.a_bytes)]
        shown[np.arange(len(b)) + np.repeat(ga[1:], per_b)] = self.b_text[b + last(gb, len(b)) * self.b_size]
        shown = shown.tolist()
        numbers = np.arange(len(cells) + 1)
        link_at, groups = (8 * np.searchsorted(lc, numbers)).tolist(), np.diff(np.searchsorted(gc, numbers)).tolist()
        a_n, b_n, text_at = np.diff(a_at).tolist(), nb.tolist(), (a_at + b_at).tolist()
        for k, c in enumerate(cells):
            self[c] = a_n[k], b_n[k], groups[k], keys[link_at[k] : link_at[k + 1]], "".join(shown[text_at[k] : text_at[k + 1]])


def _parts(batch, column: int):
    """Slices of an Arrow batch of about PART_BYTES of text, a row at least."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PART_BYTES, side="right")))
        yield batch.slice(i, j - i)
        i = j


def _documents(known: Cells, texts: list):
    """Of texts: [(tokens of A, of B, groups, links, digest)], and their pairs as (text, key, times) arrays, sorted, and (key, times) of all."""
    import numpy as np

    cells = [known.cut(t) if t else [] for t in texts]
    number: dict = {}
    for c in cells:
        number.update(dict.fromkeys(c))
    missing = [c for c in number if c not in known]
    held = {c: known[c] for c in number if c in known}  # learning may forget them
    old = dict(held)
    for i in range(0, len(missing), MOST_CELLS // 4):
        some = missing[i : i + MOST_CELLS // 4]
        known.learn(some, old)
        held.update((c, known[c]) for c in some)
    number = dict(zip(number, range(len(number)), strict=True))
    records = [held[c] for c in number]
    na, nb, ng = (np.fromiter((r[k] for r in records), np.int64, len(records)) for k in range(3))
    nl = np.fromiter((len(r[3]) >> 3 for r in records), np.int64, len(records))
    keys, names = np.frombuffer(b"".join([r[3] for r in records]), np.int64), [r[4] for r in records]
    rows, used, owner = [], [], []
    for k, c in enumerate(cells):
        at = np.fromiter(map(number.__getitem__, c), np.int64, len(c))
        said = [names[i] for i in at.tolist()]
        if not said or None in said:
            rows.append((0, 0, 0, 0, ""))
            continue
        rows.append((int(na[at].sum()), int(nb[at].sum()), int(ng[at].sum()), int(nl[at].sum()), hashlib.sha256("".join(said)[:-1].encode()).hexdigest()))
        used.append(at)
        owner.append(np.full(len(at), k))
    none = np.empty(0, np.int64)
    if not used:
        return rows, (none, none, none), (none, none)
    used, owner = np.concatenate(used), np.concatenate(owner)
    # Links of every cell in its place: pair numbers of all occurrences, text by text.
    pairs, of = np.unique(keys, return_inverse=True)
    n = nl[used]
    first = np.cumsum(nl) - nl
    link = np.repeat(first[used] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    which = of[link]
    both, times = np.unique(np.repeat(owner, n) * len(pairs) + which, return_counts=True)
    total = np.bincount(which, minlength=len(pairs))
    return rows, (both // len(pairs), pairs[both % len(pairs)], times), (pairs[total > 0], total[total > 0])


class Sums:
    """A running sum by key in sorted arrays."""

    def __init__(self):
        self.waiting, self.n = [], 0

    def add(self, keys, times) -> None:
        self.waiting.append((keys, times))
        self.n += len(keys)
        if self.n > 2 * BLOCK_PAIRS:
            self.merge()

    def merge(self):
        import numpy as np

        if self.waiting:
            keys, at = np.unique(np.concatenate([k for k, _ in self.waiting]), return_inverse=True)
            self.waiting = [(keys, np.bincount(at, np.concatenate([t for _, t in self.waiting])).astype(np.int64))]
            self.n = len(keys)
        return self.waiting[0] if self.waiting else (np.empty(0, np.int64), np.empty(0, np.int64))


DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _aligned_rows(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Where documents lie, rows of two kinds, both of a block: a document with its pairs of ids and their times (counts null),
    and a piece of the block's summed pairs (counts and keys; doc columns null)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        cache = worker_cache("alignment")
        if (a_path, b_path) not in cache:
            cache[a_path, b_path] = Cells(a_path, b_path)
        known = cache[a_path, b_path]
        block, sums, long = TaskContext.get().partitionId() << 32, Sums(), pa.int64()
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "is_doc", "pairs", "times"]
        lists = lambda at, x: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, long))

        def summed():
            keys, times = sums.merge()
            at = np.append(np.arange(0, len(keys), 4096), len(keys))
            k = len(at) - 1
            for i in range(0, k, 64):
                j = min(k, i + 64)
                cut, m = slice(at[i], at[j]), j - i
                yield pa.RecordBatch.from_arrays([*[pa.nulls(m, long)] * 5, pa.nulls(m, pa.string()), pa.array(np.full(m, block)), pa.array(np.zeros(m, bool)), lists(at[i : j + 1] - at[i], keys[cut]), lists(at[i : j + 1] - at[i], times[cut])], names=names)

        for batch in batches:
            for part in _parts(batch, 1):
                rows, (text, key, times), all_of = _documents(known, part.column(1).to_pylist())
                at = np.searchsorted(text, np.arange(len(rows) + 1))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, long) for c in columns[:4]], pa.array(columns[4], pa.string()), pa.array(np.full(len(rows), block)), pa.array(np.ones(len(rows), bool)), lists(at, key), lists(at, times)], names=names)
                sums.add(*all_of)
                if sums.n > BLOCK_PAIRS:
                    sums.merge()
                    if sums.n > BLOCK_PAIRS:
                        yield from summed()
                        block, sums = block + 1, Sums()
        yield from summed()

    slim = docs.select("doc_id", "t")
    return slim.mapInArrow(run, f"doc_id long, {DOC}, block long, is_doc boolean, pairs array<long>, times array<long>")


def _looked_up(keys, n, best, part):
    """(links whose count is the highest of their B id, sum of counts) of each row of pairs and times, given sorted keys."""
    import numpy as np

    pairs, times = part.column("pairs"), part.column("times").flatten().to_numpy(zero_copy_only=False)
    sizes = pairs.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(part.num_rows), sizes)
    at = np.searchsorted(keys, pairs.flatten().to_numpy(zero_copy_only=False))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    sums = lambda x: (c := np.concatenate(([0], np.cumsum(x))))[ends[1:]] - c[ends[:-1]]
    return sums(times * best[at]), sums(times * n[at]), row


OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
OUT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _result_batch(part, best, total):
    import pyarrow as pa

    have = {"n_best": pa.array(best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
    return pa.RecordBatch.from_arrays([have.get(c) if c in have else part.column(c) for c in OUT], names=OUT)


def _by_broadcast(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """All counts sent to every task: LOOKUP_PAIRS of them at most."""
    import numpy as np

    table = counts.select("pair", "n", "best").toArrow()
    column = lambda c: table.column(c).to_numpy()
    order = np.argsort(column("pair"))
    sent = docs.sparkSession.sparkContext.broadcast(tuple(column(c)[order] for c in ("pair", "n", "best")))

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                best, total, _ = _looked_up(*sent.value, part)
                yield _result_batch(part, best, total)

    return docs.mapInArrow(run, OUT_SCHEMA)


def _by_block(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each block's own pairs are joined with their counts and sent to where its documents go, in front of them: no table is whole anywhere."""
    mine = rows.where("NOT is_doc").select("block", F.explode("pairs").alias("key"))
    mine = mine.join(counts, F.col("key") == F.col("pair")).select("block", F.lit(False).alias("is_doc"), "key", "n", "best")
    docs = rows.where("is_doc")
    none = [F.lit(None).cast(t).alias(c) for c, t in docs.drop("block", "is_doc").dtypes]
    both = mine.select("block", "is_doc", "key", "n", "best", *none).unionByName(docs.withColumns({"key": F.lit(None).cast("long"), "n": F.lit(None).cast("long"), "best": F.lit(None).cast("boolean")}))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        block, held, table = None, [], None
        for b in batches:
            numbers = b.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if hi == lo:
                    continue
                if numbers[lo] != block:
                    block, held, table = numbers[lo], [], None
                part = b.slice(lo, hi - lo)
                is_doc = part.column("is_doc")
                facts = part.filter(pc.invert(is_doc))
                if facts.num_rows:  # they come before the block's documents
                    held.append(facts.select(["key", "n", "best"]))
                part = part.filter(is_doc)
                if part.num_rows:
                    if table is None:
                        t = pa.Table.from_batches(held) if held else None
                        get = lambda c, t=t: t.column(c).to_numpy() if t else np.empty(0, np.int64)
                        order = np.argsort(get("key"))
                        table, held = tuple(get(c)[order] for c in ("key", "n", "best")), []
                    for i in range(0, part.num_rows, 1024):
                        some = part.slice(i, 1024)
                        best, total, _ = _looked_up(*table, some)
                        yield _result_batch(some, best, total)

    return both.repartition("block").sortWithinPartitions("block", "is_doc").mapInArrow(run, OUT_SCHEMA)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of docs.

    Tokens of " " + text by a byte-level .json file (A) and of text by a sentencepiece model that adds the space (B), special strings
    as plain text.  Places where tokens of both end cut them into groups; a link is a token of A and one of B that share bytes.  A
    pair of ids counts how many links of all documents hold it; n_best counts a document's links whose pair is the most frequent of
    its B id, ties included, count_sum adds their counts.  groups_sha256 digests `a1,a2|b1;a3|b2,b3`, ids in order.  Null and empty
    texts, and those whose joined tokens are not " " + text, have zeros and an empty digest, and add to no count.  Repeated rows and
    rows without an id count each; an empty table gives no rows; other columns are not read.

    Both tokenizers cut where white space follows anything else, so a text is aligned cell by cell and a worker keeps the cells it
    has seen, a bounded number; a text without white space is one cell.  Documents stay where they are read: only sums by pair of
    blocks of documents are shuffled, and the counts come back as one table below LOOKUP_PAIRS, block by block above.
    """
    spark = docs.sparkSession
    a_path, b_path = a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE)
    path = f"{shared_dir(spark)}/aligned"
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    _aligned_rows(slim, a_path, b_path).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    out = durable(_counted(spark, rows, _b_size(b_path)))
    remove(spark, path)
    return out


def _b_size(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def _counted(spark: SparkSession, rows: DataFrame, b_size: int) -> DataFrame:
    counts, found = pair_counts(rows, b_size)
    docs = rows.where("is_doc").drop("block", "is_doc")
    return _by_broadcast(docs, counts) if found <= LOOKUP_PAIRS else _by_block(rows, counts)


def pair_counts(rows: DataFrame, b_size: int) -> tuple[DataFrame, int]:
    """((pair, n, best boolean), number of pairs): links of all documents by pair, and whether no pair of the same B id has more."""
    summed = rows.where("NOT is_doc").select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy("x.pairs").agg(F.sum("x.times").alias("n"))
    counts = durable(summed.select(F.col("pairs").alias("pair"), "n"))
    top = counts.groupBy((F.col("pair") % b_size).alias("b")).agg(F.max("n").alias("most"))
    # A row for each id of B: no more than its vocabulary.
    return counts.join(F.broadcast(top), F.col("pair") % b_size == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), counts.count()


def token_links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with links: array<struct<a int, b int, a_id int, b_id int>> in order, a and b numbers of tokens from 0; empty where align gives zeros."""
    a_path, b_path = a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE)
    (name,) = fresh(docs, "links")
    kind = "array<struct<a:int,b:int,a_id:int,b_id:int>>"

    @F.pandas_udf(kind)
    def linked(texts):
        import numpy as np
        import pandas as pd

        cache = worker_cache("alignment")
        if (a_path, b_path) not in cache:
            cache[a_path, b_path] = Cells(a_path, b_path)
        known, out = cache[a_path, b_path], []
        for t in texts:
            a, b, size = [], [], 0
            for c in known.cut(t) if t else []:
                ids_a, ids_b, raw = known.a_ids(c), known.b_ids([c])[0], c.encode()
                if not b"".join([known.a_bytes[i] for i in ids_a]) == raw == b"".join([known.b_bytes[i] for i in ids_b]):
                    a = []
                    break
                a += ids_a
                b += ids_b
                size += len(raw)
            if not a:
                out.append([])
                continue
            lengths = lambda ids, of: np.array([len(of[i]) for i in ids], np.int64)
            (la, lb, _), _ = aligned(lengths(a, known.a_bytes), lengths(b, known.b_bytes), np.array([size]))
            out.append([{"a": i, "b": j, "a_id": a[i], "b_id": b[j]} for i, j in zip(la.tolist(), lb.tolist(), strict=True)])
        return pd.Series(out)

    return docs.withColumn(name, linked(F.col(text_col)))
