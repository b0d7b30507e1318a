"""The operators in SQL: temporary functions for strings and records, table functions for sequences.

    register(spark)
    spark.sql("SELECT tw_normal(str) FROM terms")
    spark.sql("SELECT * FROM tw_composite_phrases(TABLE(phrases) PARTITION BY (doc_id, utt_no) ORDER BY no)")

String functions are SQL expressions, inlined into the query's plan; table functions run once for each group on the executors.
"""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from .functions import text as T
from .operators.termfilter import PREPOSITIONS

_or = "|".join


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


#: (name, arguments, type, body); later ones use earlier ones.
FUNCTIONS: tuple[tuple[str, str, str, str], ...] = (
    ("tw_parse_record", "line STRING", "ARRAY<STRING>", "if(endswith(line, '|'), slice(split(line, '[|]', -1), 1, size(split(line, '[|]', -1)) - 1), split(line, '[|]', -1))"),
    ("tw_strip_nos", "s STRING", "STRING", "regexp_replace(s, r',? NOS$', '')"),
    ("tw_uninvert", "s STRING", "STRING", rf"if(s RLIKE r'^[^,]*[^, ][^,]*(, [^, ][^,]*)+$' AND NOT lower(s) RLIKE r'(^|[^a-z])({_or(T.LINKING_WORDS)})([^a-z]|$)', array_join(reverse(split(s, ', ')), ' '), s)"),
    ("tw_strip_left_parentheticals", "s STRING", "STRING", rf"regexp_replace(s, r'^(?:\[(?:{_or(T.LEFT_PARENTHETICALS)})\][ \t]*)+', '')"),
    ("tw_strip_hyphens", "s STRING", "STRING", "regexp_replace(replace(s, '-', ' '), ' {2,}', ' ')"),
    ("tw_strip_possessives", "s STRING", "STRING", 'regexp_replace(s, r"([A-Za-z0-9]+)\'s([^A-Za-z0-9]|$)|([A-Za-z0-9]*s)\'([^A-Za-z0-9]|$)", "$1$2$3$4")'),
    ("tw_cut", "s STRING", "STRING", "tw_strip_left_parentheticals(tw_uninvert(tw_strip_nos(s)))"),
    ("tw_normal", "s STRING", "STRING", "trim(tw_strip_possessives(tw_strip_hyphens(lower(tw_cut(s)))))"),
    ("tw_changes", "p ARRAY<STRING>", "ARRAY<STRING>", "array_compact(transform(array('nos', 'uninv', 'parenth', 'case', 'hyphen', 'poss'), (t, i) -> if(p[i] <> p[i + 1], t, NULL)))"),
    ("tw_normal_types", "s STRING", "ARRAY<STRING>", "tw_changes(array(s, tw_strip_nos(s), tw_uninvert(tw_strip_nos(s)), tw_cut(s), lower(tw_cut(s)), tw_strip_hyphens(lower(tw_cut(s))), tw_strip_possessives(tw_strip_hyphens(lower(tw_cut(s))))))"),
    ("tw_words", "s STRING", "ARRAY<STRING>", "regexp_extract_all(s, '([a-z0-9]+)')"),
    ("tw_delimited_terms", "s STRING", "ARRAY<STRING>", r"filter(split(s, r'[!-/:-@\[-`{-~ \t\n\r\f]+'), x -> x <> '')"),
    ("tw_clean", "s STRING", "STRING", r"regexp_replace(trim(s), r'[ \t\n\r\f]+', ' ')"),
    ("tw_is_lowercase", "s STRING", "BOOLEAN", "coalesce(s RLIKE '[a-z]' AND NOT s RLIKE '[A-Z]', true)"),
    ("tw_ascii_upper", "s STRING", "STRING", "translate(s, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"),
    ("tw_print_cui", "ts STRING, stt STRING, cui STRING", "STRING", f"if(ts = 'P' AND stt = 'PF', '{T.CONCEPT_PLACEHOLDER}', cui)"),
    ("tw_restore_status", "line STRING", "STRING", "if(locate('|p|', line) > 0, concat(substring(line, 1, locate('|p|', line) - 1), '|P|', substring(line, locate('|p|', line) + 3)), line)"),
    ("tw_is_preposition", "w STRING", "BOOLEAN", f"coalesce(lower(w) IN ({_quoted(PREPOSITIONS)}), false)"),
    ("tw_specific_types", "types ARRAY<STRING>", "ARRAY<STRING>", "if(size(types) > 1 AND size(array_except(types, array('qlco', 'fndg'))) > 0, filter(types, t -> t NOT IN ('qlco', 'fndg')), types)"),
    ("tw_code_depth", "code STRING", "INT", "if(length(code) > 0, size(split(code, '[.]')), 0)"),
)


@udtf(returnType="doc_id: bigint, utt_no: bigint, island: int, value: string")
class CompositePhrases:
    """From an utterance's phrases in order (doc_id, utt_no, no, text, category, preps): a row for each phrase that prepositional ones follow.

    category: that of the phrase's first item; preps: what that item matched in the lexicon.  A phrase that does not begin with a
    preposition opens an island; islands of one phrase give no row.
    """

    def __init__(self):
        self.key, self.number, self.texts, self.preps = None, 0, [], []

    def eval(self, row):
        prep = row["category"] == "prep"
        if not prep:
            yield from self._close()
            self.number += 1
        self.key = row["doc_id"], row["utt_no"]
        self.texts.append((row["text"] or "").lower())
        if prep:
            self.preps += row["preps"] or []

    def terminate(self):
        yield from self._close()

    def _close(self):
        if len(self.texts) > 1:
            yield *self.key, self.number, f"{len(self.texts)}|[{','.join(self.preps)}]|[{','.join(self.texts)}]"
        self.texts, self.preps = [], []


@udtf(returnType="doc_id: bigint, utt_no: bigint, label: string, text: string, phrases: string")
class Utterances:
    """From an utterance's flat sequence in order (doc_id, utt_no, seq, kind, value), value in JSON: the utterance, its phrases as a JSON list.

    The sequence is an utterance, then for each phrase a phrase, candidates and mappings, then EOU; another order is an error.
    """

    def __init__(self):
        self.head, self.key, self.phrases, self.wanted = None, None, [], ("utterance",)

    def eval(self, row):
        kind, value = row["kind"], row["value"]
        if kind not in self.wanted:
            raise ValueError(f"utterance {row['utt_no']} of {row['doc_id']}: expected {' or '.join(self.wanted)}, found {kind}")
        if kind == "utterance":
            self.key, self.head = (row["doc_id"], row["utt_no"]), json.loads(value)
        elif kind == "phrase":
            self.phrases.append(json.loads(value))
        elif kind != "EOU":
            self.phrases[-1].update(json.loads(value))
        self.wanted = {"utterance": ("phrase", "EOU"), "phrase": ("candidates",), "candidates": ("mappings",), "mappings": ("phrase", "EOU"), "EOU": ()}[kind]

    def terminate(self):
        if self.wanted:
            raise ValueError(f"expected {' or '.join(self.wanted)}, found the end of the sequence")
        yield *self.key, self.head.get("label"), self.head.get("text"), json.dumps(self.phrases)


TABLE_FUNCTIONS = {"tw_composite_phrases": CompositePhrases, "tw_utterances": Utterances}


def register(spark: SparkSession) -> None:
    """Makes all functions known to the session; a second time replaces them."""
    for name, arguments, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    for name, f in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, f)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
