"""Annotated documents from files of terms, and back: header terms, then for each utterance its phrases, candidates and mappings.

A file is a sequence of terms, each ended by a full stop at the end of a line: for each document args/2, aas/1 and neg_list/1, then for
each utterance utterance/4, (phrase/4, candidates/5, mappings/1) for each phrase, and 'EOU'; 'EOT' may end a document.
"""

from __future__ import annotations

import json
import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.annotations import PHRASE

#: Quoted text or a name, and whether a bracket touches it; a number; a mark; anything else.
TOKEN = re.compile(r"""\s*(?:(?:('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*")|(-?\d+(?:\.\d+)?)(?!\w)|([^\W\d]\w*|[^\s\w\[\](),|'"]+))(\()?|([\[\](),|])|(\S))""", re.DOTALL)
HEADER = "struct<args:string,aas:string,neg_list:string>"
PARSED = f"path string, piece long, seq long, doc long, utt long, starts boolean, ends boolean, header {HEADER}, label string, text string, pos struct<start:int,length:int>, phrases array<{PHRASE}>"


class TermError(ValueError):
    """Input that is not the term, or the sequence of terms, that must come here."""


class Terms:
    """Reads terms from a string: (name, [arguments]) for compounds, lists, str for atoms and strings, int or float for numbers.

    The string is cut into tokens once.  A name and the bracket of its arguments touch.
    """

    def __init__(self, source: str):
        self.at, self.tokens = 0, TOKEN.findall(source)

    def near(self) -> str:
        """What stands here, for an error."""
        return repr("".join("".join(t) for t in self.tokens[self.at : self.at + 20])[:60]) if self.at < len(self.tokens) else "the end of input"

    def next(self):
        """The next term, None at the end of input."""
        if self.at == len(self.tokens):
            return None
        term = self.value()
        if self.at == len(self.tokens):
            raise TermError(f"input ends within a term: {str(term)[-60:]!r}")
        if self.tokens[self.at][2] != ".":
            raise TermError(f"a term must end with a full stop, found {self.near()} after {str(term)[:60]}")
        self.at += 1
        return term

    def value(self):
        left, tokens = self.primary(), self.tokens
        while self.at < len(tokens) and (op := tokens[self.at][2]) in ("/", ":", "-") and op:
            self.at += 1
            left = (op, [left, self.primary()])
        return left

    def primary(self):
        if self.at == len(self.tokens):
            raise TermError("input ends within a term")
        quoted, number, name, bracket, mark, _ = self.tokens[self.at]
        self.at += 1
        if mark == "[":
            return self.items("]")
        if name and name != ".":
            return (name, self.items(")")) if bracket else name
        if number:
            if not bracket:
                return float(number) if "." in number else int(number)
        elif quoted:
            q, text = quoted[0], quoted[1:-1]
            if q in text:
                text = text.replace(q * 2, q)
            if "\\" in text:
                text = re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)
            if not bracket:
                return text
            if q == "'":
                return (text, self.items(")"))
        elif mark == "(":
            return self.items(")")[0]
        self.at -= 1
        raise TermError(f"not a term: {self.near()}")

    def items(self, close: str) -> list:
        out, tokens, n = [], self.tokens, len(self.tokens)
        if self.at < n and tokens[self.at][4] == close:
            self.at += 1
            return out
        while True:
            out.append(self.value())
            if self.at == n:
                raise TermError("input ends within a term")
            mark = tokens[self.at][4]
            if mark == close:
                self.at += 1
                return out
            if mark != "," and mark != "|":
                raise TermError(f"expected , or {close}, found {self.near()}")
            self.at += 1


def expect(term, name: str, *arity: int):
    """The arguments of a term of that name, or an error that says what was found."""
    if isinstance(term, tuple) and term[0] == name and len(term[1]) in arity:
        return term[1]
    raise TermError(f"expected {name}/{arity[0]}, found {'the end of input' if term is None else str(term)[:80]}")


def show(x) -> str:
    """A term as text, as it is read but for spaces and quotes."""
    if isinstance(x, list):
        return "[" + ",".join(map(show, x)) + "]"
    if isinstance(x, tuple):
        return x[0].join(map(show, x[1])) if x[0] in ("/", ":", "-") else f"{x[0]}({','.join(map(show, x[1]))})"
    return str(x)


def _span(x):
    start, length = expect(x, "/", 2)
    return {"start": start, "length": length}


def _words(x) -> list:
    return [show(w) for w in x] if isinstance(x, list) else [show(x)]


def _candidate(x) -> dict:
    """ev of twelve fields gets a thirteenth, not negated."""
    f = expect(x, "ev", 12, 13)
    spans = [{"p1": a[0], "p2": a[1], "m1": b[0], "m2": b[1], "lex": lex} for a, b, lex in f[6]]
    return {"neg_value": f[0], "cui": f[1], "meta_term": show(f[2]), "preferred_name": show(f[3]), "meta_words": _words(f[4]), "sem_types": _words(f[5]), "match_map": spans, "involves_head": f[7], "is_overmatch": f[8], "sources": _words(f[9]), "pos": [_span(s) for s in f[10]], "status": f[11], "negated": f[12] if len(f) == 13 else 0}


def _item(x) -> dict:
    if not isinstance(x, tuple) or len(x[1]) != 1:
        raise TermError(f"expected an item of a phrase, found {show(x)[:80]}")
    found = {f[0]: f[1][0] for f in x[1][0] if isinstance(f, tuple)}
    return {"category": x[0], "tag": show(found["tag"]) if "tag" in found else None, **{k: _words(found.get(k, [])) for k in ("inputmatch", "lexmatch", "tokens")}}


def parse_block(value: str, whole: bool = True) -> dict | None:
    """One utterance with the header terms before it; backslashes of the utterance's own line stand for themselves.

    Unless `whole`, what follows the utterance's own line is not read, and phrases are null.  None where nothing is left but an end of document.  Anything else that is not as it must be raises TermError.
    """
    if not whole and (cut := re.search(r"(?m)^phrase\(", value)):
        value = value[: cut.start()]
    value = re.sub(r"(?m)^(utterance\(.*)$", lambda m: m[0].replace("\\", "\\\\"), value)
    terms, out = Terms(value), {"starts": False, "ends": False, "header": None}
    term = terms.next()
    while term == "EOT":
        term = terms.next()
    if term is None:
        return None
    if isinstance(term, tuple) and term[0] == "args":
        args = expect(term, "args", 2)
        aas, neg = expect(terms.next(), "aas", 1), expect(terms.next(), "neg_list", 1)
        out |= {"starts": True, "header": {"args": show(args), "aas": show(aas[0]), "neg_list": show(neg[0])}}
        term = terms.next()
        while term == "EOT":
            term = terms.next()
        if term is None:
            return out | {"label": None, "text": None, "pos": None, "phrases": None}
    label, text, pos, _ = expect(term, "utterance", 4)
    out |= {"label": show(label), "text": text, "pos": _span(pos), "phrases": []}
    if not whole:
        return out | {"phrases": None}
    while (term := terms.next()) is not None and term != "EOU":
        phrase, syntax, span, _ = expect(term, "phrase", 4)
        total, excluded, pruned, remaining, evs = expect(terms.next(), "candidates", 5)
        maps = [expect(m, "map", 2) for m in expect(terms.next(), "mappings", 1)[0]]
        out["phrases"].append({
            "no": len(out["phrases"]), "text": show(phrase), "items": [_item(i) for i in syntax], "counts": {"total": total, "excluded": excluded, "pruned": pruned, "remaining": remaining},
            "cands": [_candidate(e) for e in evs], "mappings": [{"neg_score": s, "evs": [_candidate(e) for e in m]} for s, m in maps], "pos": _span(span),
        })
    if not out["phrases"]:
        raise TermError(f"utterance {out['label']} has no phrases")
    return out


#: Lines as term_lines writes them, once quoted atoms are taken out and \\0 stands for each; anything else is left to Terms.
QUOTED = re.compile(r"'([^']*(?:''[^']*)*)'")
_N, _QS = r"(-?\d+)", r"\[((?:\0(?:,\0)*)?)\]"
PLAIN_STEPS = (
    (re.compile(rf"(?<![a-z0-9_])([a-z][a-z0-9_]*)\(\[(?:lexmatch\({_QS}\),)?(?:inputmatch\({_QS}\),)?tokens\({_QS}\)\]\)"), r'{"category":"\1","tag":null,"lexmatch":[\2],"inputmatch":[\3],"tokens":[\4]}'),
    (re.compile(rf"(?<=[\[,]){_N}/{_N}"), r'{"start":\1,"length":\2}'),
    (re.compile(rf"\[\[{_N},{_N}\],\[{_N},{_N}\],{_N}\]"), r'{"p1":\1,"p2":\2,"m1":\3,"m2":\4,"lex":\5}'),
    (
        re.compile(rf"ev\({_N},\0,\0,\0,{_QS},{_QS},\[([^\[\]]*)\],([a-z][a-z0-9_]*),([a-z][a-z0-9_]*),{_QS},\[([^\[\]]*)\],{_N},{_N}\)"),
        '{"neg_value":\\1,"cui":\0,"meta_term":\0,"preferred_name":\0,"meta_words":[\\2],"sem_types":[\\3],"match_map":[\\4],"involves_head":"\\5","is_overmatch":"\\6","sources":[\\7],"pos":[\\8],"status":\\9,"negated":\\10}',
    ),
    (re.compile(rf"map\({_N},\["), r'{"neg_score":\1,"evs":['),
)
PLAIN_PHRASE = re.compile(rf"phrase\(\0,\[(.*)\],(\{{[^{{}}]*\}}),\[\]\)[.]\ncandidates\({_N},{_N},{_N},{_N},\[(.*)\]\)[.]\nmappings\(\[(.*)\]\)[.](?:\n|\Z)")


def plain_phrases(value: str) -> str | None:
    """The phrases of a block from its first phrase on as JSON, by a few replacements over the whole; None where it is not plain.

    What is no term of the forms above stays as it is, which a reader of JSON with the schema then refuses.
    """
    if "\\" in value or '"' in value or "\0" in value:
        return None
    parts = QUOTED.split(value)
    words, x = parts[1::2], "\0".join(parts[0::2])
    if "'" in x or "{" in x:
        return None
    for pattern, text in PLAIN_STEPS:
        x = pattern.sub(text, x)
    out, at = [], 0
    while at < len(x):
        m = PLAIN_PHRASE.match(x, at)
        if not m:
            return None
        items, pos, total, excluded, pruned, remaining, cands, maps = m.groups()
        out.append(f'{{"no":{len(out)},"text":\0,"items":[{items}],"counts":{{"total":{total},"excluded":{excluded},"pruned":{pruned},"remaining":{remaining}}},"cands":[{cands}],"mappings":[{maps.replace("])", "]}")}],"pos":{pos}}}')
        at = m.end()
    around = ",".join(out).replace("\0", '"\0"').split("\0")
    if not out or len(around) != len(words) + 1:
        return None
    filled = [""] * (2 * len(words) + 1)
    filled[0::2] = around
    filled[1::2] = json.dumps("\0".join(words).replace("''", "'"), ensure_ascii=False)[1:-1].split("\\u0000") if words else []
    return f"[{''.join(filled)}]"


def block_json(value: str) -> tuple[dict | None, str | None]:
    """parse_block's result, without phrases where they come beside it as JSON."""
    if cut := re.search(r"(?m)^phrase\(", value):
        try:
            if (phrases := plain_phrases(value[cut.start() :])) and (one := parse_block(value[: cut.start()], whole=False)) and one["label"] is not None:
                return one, phrases
        except (TermError, ValueError, TypeError, IndexError, KeyError):
            pass  # the whole block says what is wrong
    return parse_block(value), None


#: What shows that a block begins a document, and that it holds an utterance, before it is parsed.
STARTS = r"^\s*(?:'?EOT'?\s*[.]\s*)*'?args'?[(]"
SAID = r"(?m)^\s*'?utterance'?[(]"
#: Pieces of files whose document numbers are broadcast; beyond it they are joined.
BROADCAST_PIECES = 200_000


def _numbers_before(blocks: DataFrame) -> DataFrame:
    """(path, piece, earlier, docs, utts): documents of the paths before this one in order, those of a path begun before a piece, and
    utterances since the last of them began.  What stands before a path's first header is a document too.

    blocks lie in pieces, in order within each; a piece gives one row, and only those rows are put in order by path.
    """
    from ..operators.steps import written

    def tally(batches):
        import pyarrow as pa

        seen: dict = {}
        for b in batches:
            for path, piece, starts, said in zip(*(c.to_pylist() for c in b.columns), strict=True):
                docs, utts, lead = seen.get((path, piece), (0, 0, 0))
                seen[path, piece] = (docs + starts, (0 if starts else utts) + said, lead + (said if docs + starts == 0 else 0))
        columns = list(zip(*[(*k, *c) for k, c in seen.items()], strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=["path", "piece", "n", "tail", "lead"])

    starts, said = F.regexp_like("value", F.lit(STARTS)).cast("int"), F.regexp_like("value", F.lit(SAID)).cast("int")
    # A row a piece, used twice below: written, so that blocks are read once.
    x = written(blocks.select("path", "piece", starts.alias("starts"), said.alias("said")).mapInArrow(tally, "path string, piece long, n long, tail long, lead long"))
    before = Window.partitionBy("path").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("docs", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # Utterances since the last piece in which a document begins, and those of all pieces after it.
    group = Window.partitionBy("path", "from").orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("from", F.max(F.when(F.col("n") > 0, F.col("piece"))).over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("sofar", F.sum("tail").over(group))
    w = Window.partitionBy("path").orderBy("piece")
    x = x.select("path", "piece", "docs", "n", F.when(F.col("docs") == 0, F.col("lead")).alias("lead"), F.coalesce(F.lag("sofar").over(w), F.lit(0)).alias("utts"))
    files = x.groupBy("path").agg((F.max("lead") > 0).cast("long").alias("lead"), F.sum("n").alias("n"))
    order = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = files.select(F.col("path").alias("f"), (F.coalesce(F.sum(F.col("n") + F.col("lead")).over(order), F.lit(0)) + F.col("lead")).alias("earlier"))
    return x.join(files, F.col("path") == F.col("f")).select("path", "piece", "earlier", "docs", "utts")


def _parsed(blocks: DataFrame) -> DataFrame:
    """blocks (path, piece, seq, value), in order within their pieces, parsed where they lie: each once."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(blocks.sparkSession.createDataFrame([], PARSED).schema)

    def checked(path, seq, value, starts, said, read):
        try:
            one, phrases = read(value)
            if bool(one and one["starts"]) != bool(starts) or bool(one and one["label"] is not None) != bool(said):
                raise TermError("a term of another name begins a line of a quoted text, or lacks its line")
        except (TermError, ValueError, TypeError, IndexError, KeyError) as e:
            raise TermError(f"{path}, block {seq}: {e}") from e
        return one, phrases

    def by_json(rows):
        """Rows and their phrases by Arrow's own reader of JSON; None where it finds anything that the schema lacks."""
        import pyarrow as pa
        from pyarrow import json as pj

        lines = [text if phrases is None else f'{text[:-1]},"phrases":{phrases}}}' for row, phrases in rows for text in [json.dumps(row, ensure_ascii=False)]]
        try:
            data = "\n".join(lines).encode()
            t = pj.read_json(pa.BufferReader(data), pj.ReadOptions(use_threads=False, block_size=len(data) + 1), pj.ParseOptions(explicit_schema=schema, unexpected_field_behavior="error"))
            return t.select(schema.names).cast(schema).combine_chunks().to_batches()
        except (pa.ArrowException, ValueError):
            return None

    def parse(batches):
        import pyarrow as pa

        at, doc, utt = None, 0, 0
        for b in batches:
            for i in range(0, b.num_rows, 256):
                rows, values = [], []
                for path, piece, seq, value, starts, said in zip(*(c.to_pylist() for c in b.slice(i, 256).columns), strict=True):
                    if (path, piece) != at:
                        at, doc, utt = (path, piece), 0, 0
                    one, phrases = checked(path, seq, value, starts, said, block_json)
                    if starts:
                        doc, utt = doc + 1, 0
                    utt += said
                    if one:
                        one = one if phrases is None else {k: v for k, v in one.items() if k != "phrases"}
                        rows.append(({"path": path, "piece": piece, "seq": seq, "doc": doc, "utt": utt, **one}, phrases))
                        values.append((path, seq, value, starts, said))
                if not rows:
                    continue
                made = by_json(rows) if any(p is not None for _, p in rows) else None
                if made is None:
                    made = [pa.RecordBatch.from_pylist([r if p is None else r | checked(*v, lambda x: (parse_block(x), None))[0] for (r, p), v in zip(rows, values, strict=True)], schema=schema)]
                yield from made

    return blocks.select("path", "piece", "seq", "value", F.regexp_like("value", F.lit(STARTS)).cast("int").alias("starts"), F.regexp_like("value", F.lit(SAID)).cast("int").alias("said")).mapInArrow(parse, PARSED)


def _numbered(blocks: DataFrame) -> DataFrame:
    from ..operators.steps import written

    before = written(_numbers_before(blocks)).select(F.col("path").alias("p"), F.col("piece").alias("c"), "earlier", "docs", "utts")
    x = _parsed(blocks).join(F.broadcast(before) if before.count() <= BROADCAST_PIECES else before, (F.col("path") == F.col("p")) & (F.col("piece") == F.col("c")))
    utt = F.col("utt") + F.when(F.col("doc") == 0, F.col("utts")).otherwise(F.lit(0))
    return x.withColumn("doc_no", F.col("docs") + F.col("doc")).withColumn("doc_ord", F.col("earlier") + F.col("doc_no")).withColumn("utt_no", utt).withColumn("doc_id", F.substring_index("label", ".", 1)).drop("p", "c", "piece", "earlier", "docs", "utts", "doc", "utt", "ends")


def parse_blocks(blocks: DataFrame, partitions: int | None = None) -> DataFrame:
    """blocks: (path, seq, value), a row an utterance with what comes before it.  Adds to the columns of PARSED: doc_no and utt_no within the path, doc_ord, a document's number over all paths in order, and doc_id, the label up to its first full stop.

    Blocks are sorted in ranges of (path, seq) and written once; documents are numbered by a row for each range, so a long file is
    in no task as a whole, and every block is parsed once, on the executors.  A malformed term fails the query with TermError and the
    place.  Blocks with nothing but an end of document go.
    """
    from ..operators.steps import written

    n = partitions or int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = blocks.select("path", "seq", "value").repartitionByRange(n, "path", "seq").sortWithinPartitions("path", "seq")
    return _numbered(written(x.select("path", F.spark_partition_id().cast("long").alias("piece"), "seq", "value")))


def read_annotated(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """parse_blocks over files: a file is cut at the ends of utterances where Spark splits it, and nothing is sorted or shuffled.

    doc_no counts the documents of a file, doc_ord those of all files in the order of their paths.  A path given twice is read once.
    """
    path = list(dict.fromkeys([path] if isinstance(path, str) else path))
    x = spark.read.option("lineSep", "\n'EOU'.\n").text(path)
    # Ids grow along a file and its splits; a split is a piece.
    x = x.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("piece"), F.monotonically_increasing_id().alias("seq"), "value")
    return _numbered(x.where(F.trim(F.regexp_replace("value", r"\s+", " ")) != ""))


def _atom(x: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))


def _list(x: Column, each=None) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(x, each) if each else x, ","), F.lit("]"))


def _ev(e: Column) -> Column:
    atoms = lambda c: _list(e[c], _atom)
    spans = _list(e["match_map"], lambda m: F.concat(F.lit("[["), F.concat_ws(",", m["p1"], m["p2"]), F.lit("],["), F.concat_ws(",", m["m1"], m["m2"]), F.lit("],"), m["lex"].cast("string"), F.lit("]")))
    fields = [e["neg_value"].cast("string"), _atom(e["cui"]), _atom(e["meta_term"]), _atom(e["preferred_name"]), atoms("meta_words"), atoms("sem_types"), spans, e["involves_head"], e["is_overmatch"], atoms("sources"), _list(e["pos"], _pos), e["status"].cast("string"), e["negated"].cast("string")]
    return F.concat(F.lit("ev("), F.concat_ws(",", *fields), F.lit(")"))


def _pos(s: Column) -> Column:
    return F.concat_ws("/", s["start"], s["length"])


def item_text(i: Column, atom=lambda w: w) -> Column:
    """An item of a phrase as a term; features that it lacks are left out."""
    part = lambda name, value: F.concat(F.lit(f"{name}("), value, F.lit(")"))
    words = lambda c: F.when(F.size(i[c]) > 0, part(c, _list(i[c], atom)))
    return F.concat(i["category"], F.lit("(["), F.concat_ws(",", words("lexmatch"), words("inputmatch"), part("tag", i["tag"]), part("tokens", _list(i["tokens"], atom))), F.lit("])"))


def items_text(items: Column) -> Column:
    """A phrase's items as a list of terms."""
    return _list(items, lambda i: item_text(i, _atom))


def evs_text(cands: Column) -> Column:
    """Candidates as a list of terms."""
    return _list(cands, _ev)


def term_lines(u: DataFrame) -> DataFrame:
    """(doc_id, utt_no, value): each utterance as its lines of terms, header terms before a document's first one; what parse_blocks reads."""
    first = F.col("utt_no") == F.min("utt_no").over(Window.partitionBy("doc_id"))
    head = F.when(first, F.array(F.lit("args('termweave',[])."), F.lit("aas([])."), F.lit("neg_list([])."))).otherwise(F.array().cast("array<string>"))
    said = F.concat(F.lit("utterance("), _atom(F.col("label")), F.lit(',"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('",0/'), F.length("text").cast("string"), F.lit(",[])."))
    lines = lambda p: F.array(
        F.concat(F.lit("phrase("), _atom(p["text"]), F.lit(","), _list(p["items"], lambda i: item_text(i, _atom)), F.lit(","), _pos(p["pos"]), F.lit(",[]).")),
        F.concat(F.lit("candidates("), F.concat_ws(",", *[p["counts"][c] for c in ("total", "excluded", "pruned", "remaining")]), F.lit(","), _list(p["cands"], _ev), F.lit(").")),
        F.concat(F.lit("mappings("), _list(p["mappings"], lambda m: F.concat(F.lit("map("), m["neg_score"].cast("string"), F.lit(","), _list(m["evs"], _ev), F.lit(")"))), F.lit(").")),
    )
    return u.select("doc_id", "utt_no", F.array_join(F.concat(head, F.array(said), F.flatten(F.transform("phrases", lines)), F.array(F.lit("'EOU'."))), "\n").alias("value"))


# The parser's functions travel with the query, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
