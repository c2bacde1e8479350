"""Spans of credentials in texts (operator 2).

All rules are compiled into one minimal deterministic automaton (see `automaton`). A text's
bytes run through its transition array once, which reports every byte at which a rule's scan part
ends. From there the rule's backward automaton finds where the match starts, not before the end of the
kind's last match, and its forward automaton how far the match goes. So the spans of a
kind are those of its expression, leftmost, longest and non-overlapping; what fails the
kind's length test is dropped afterwards. Reports within a match that is already known are passed
over, so each byte is read a bounded number of times however long a run of it is.

A scan part is the start of the match as far as it takes to know that one is there. It counts
only as far as needed, because counters of different rules multiply in the joined automaton; the forward
automaton has the full counts. Rules must be such that of two matches of one kind the one that starts
first also ends its scan part first.

Work is by row: no shuffle, no state between rows, and memory of one batch.

Defined results: a null text is empty and has no spans; rows are independent, so repeated
rows and null ids each give their own row; offsets are code points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm import bytearrays as B
from tallyboard.llm.automaton import compile_rules


@dataclass(frozen=True)
class Rule:
    kind: str
    #: The start of a match, as far as it takes to know that one is there.
    scan: str
    #: The whole match.
    exact: str
    #: The least bytes of what counts.
    least: int = 1
    #: What counts starts with the last byte of the scan part, not with the match.
    from_last: bool = False


def either_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "(" + "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
_ASSIGN = _NAMES + r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = r"[A-Za-z0-9+/_.=-]"

_PART = "[A-Za-z0-9_-]"

#: In the order in which kinds at the same start are listed.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", _ASSIGN + _VALUE, _ASSIGN + _VALUE + "+", least=8, from_last=True),
    Rule("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", least=16),
    Rule("hex", "[0-9a-f]{32}", "[0-9a-f]+", least=32),
    Rule("key_block", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("signed_token", rf"eyJ{_PART}+\.eyJ{_PART}+\.{_PART}", rf"eyJ{_PART}{{10,}}\.eyJ{_PART}{{10,}}\.{_PART}{{10,}}"),
    Rule("forge_token", "gh[oprsu]_[A-Za-z0-9]", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@", r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@"),
)

SPANS = "array<struct<kind:string,start:bigint,stop:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


class Scanner:
    """The automata of some rules. `spans` gives a text's spans as (start, position of the rule, end) in bytes, in order."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.joined = compile_rules([r.scan for r in rules])
        self.back = [compile_rules([r.scan], anywhere=False, backward=True) for r in rules]
        self.forth = [compile_rules([r.exact], anywhere=False) for r in rules]

    def ready(self):
        read, back, forth = self.joined.reader(), [a.reach() for a in self.back], [a.reach() for a in self.forth]
        each = list(enumerate(self.rules))

        def spans(data: bytes) -> list[tuple[int, int, int]]:
            done, hits, view = [0] * len(each), [], memoryview(data)

            def report(at: int, found: int) -> None:
                for k, rule in each:
                    if found >> k & 1 and at > done[k]:
                        before = back[k](reversed(view[done[k] : at]))
                        if before < 0:
                            continue
                        start = at - before
                        length = forth[k](view[start:])
                        if length < 0:
                            continue
                        done[k] = start + length
                        if done[k] - (at - 1 if rule.from_last else start) >= rule.least:
                            hits.append((start, k, done[k]))

            read(data, report)
            return sorted(hits)

        return spans


def _points(data: bytes, hits: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> list[dict]:
    """Spans by kind, in code points."""
    place = None
    if hits and not data.isascii():
        place = np.concatenate([[0], np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)])
    point = (lambda i: i) if place is None else (lambda i: int(place[i]))
    return [{"kind": rules[k].kind, "start": point(a), "stop": point(b)} for a, k, b in hits]


def _scan(rules: tuple[Rule, ...]):
    scanner = Scanner(rules)

    def run(batches):
        spans_of = scanner.ready()
        for batch in batches:
            for part in B.chunks(batch, "text"):
                spans = [_points(t, spans_of(t), rules) for t in B.row_bytes(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(spans, type=_ARROW_SPANS)], names=["id", "spans"])

    return run


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of `docs`: its id and its spans, by start, then in the order of the rules."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_scan(rules), f"id {base.schema['id'].dataType.simpleString()}, spans {SPANS}").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of `spans` (one row per id) replaced; overlapping spans are replaced once."""
    cut = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda a, s: F.struct(
            F.when(s.start >= a["at"], F.concat(a["out"], F.substring(F.col(text_col), (a["at"] + 1).cast("int"), (s.start - a["at"]).cast("int")), F.lit(mask)))
            .otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s.stop).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(F.col(text_col), (a["at"] + 1).cast("int"), F.length(text_col))),
    )
    return docs.join(spans.where(F.size("spans") > 0), id_col, "left").withColumn(text_col, F.when(F.size("spans") > 0, cut).otherwise(F.col(text_col))).drop("spans")
