"""Whole copies are told by row where rows share an id."""

from __future__ import annotations

import pytest

from tallyboard.llm import substring_dedup
from tests.llm.test_operators import frame, removed_plainly


def words(name: str, n: int) -> str:
    return " ".join(f"{name}{k}" for k in range(n))


@pytest.mark.parametrize("hot", [256, 1])
def test_a_copy_does_not_stand_for_the_other_rows_of_its_id(spark, hot):
    own = words("own", 120)
    rows = [(1, words("a", 90)), (2, words("a", 90)), (2, own), (2, None), (3, "before " + words("own", 100) + " after"), (4, words("a", 90)), (4, "x " + own + " y")]
    got = substring_dedup.remove_repeats(frame(spark, rows), window=50, hot=hot).collect()
    assert sorted((tuple(r) for r in got), key=repr) == removed_plainly(rows, 50)


def test_ids_of_any_type(spark):
    from tallyboard.llm import substring_dedup

    rows = [(7, "a b c d e f"), (12, "x a b c d e f y"), (3, "n a b c d q"), (None, "a b c d"), (3, "a b c d e")]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(plain, window=4).collect()), key=repr)
    named = spark.createDataFrame([(None if i is None else f"doc-{i:04d}", t) for i, t in rows], "doc_id string, text string")
    got = sorted(((None if r.doc_id is None else int(r.doc_id[4:]), r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(named, window=4).collect()), key=repr)
    assert got == want
    assert {(r.doc_id, r.longest) for r in substring_dedup.longest_repeats(named, window=2).collect()} == {(f"doc-{r.doc_id:04d}", r.longest) for r in substring_dedup.longest_repeats(plain, window=2).collect()}
