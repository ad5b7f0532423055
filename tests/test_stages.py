"""Stages against plain models on drawn rows: recode, filters, validation, end
candidates, choice, merge."""

import random

import pytest

from helpers import assert_same_rows, make_df
from matchspan.config import EndReason, MatchConfig
from matchspan.operators import prepare
from matchspan.operators.ranges import choose_final_end, connect_ranges, end_candidates, mark_valid_starts
from matchspan.operators.validate import reduce_and_validate
from model import _direction, _pass

NAMES = {"start": 1, "update": 2, "end": 3}
CFG = (MatchConfig("a", "b", "t", "status", NAMES, ["o1", "o2"], "v")
       .filter_null_a().filter_null_b_on_start())


@pytest.mark.parametrize("value,expected", [("other", None), (None, None), ("start", 1), ("update", 2), ("end", 3)])
def test_recode_status(spark, value, expected):
    df = make_df(spark, [(value, "x")], "status string, o1 string")
    out = prepare.recode_status(df, CFG)
    assert dict(out.dtypes)["status"] == "int"
    assert_same_rows(out, [(expected, "x")])


@pytest.mark.parametrize("row,kept", [(("a", 1), True), (("a", None), False), ((None, 1), False)])
def test_filter_null_time(spark, row, kept):
    out = prepare.filter_null_time(make_df(spark, [row], "a string, t int"), CFG)
    assert_same_rows(out, [row] if kept else [])


@pytest.mark.parametrize("row,kept", [(("a", "b"), True), (("a", None), True), ((None, "b"), True), ((None, None), False)])
def test_filter_both_null(spark, row, kept):
    out = prepare.filter_both_null(make_df(spark, [row], "a string, b string"), CFG)
    assert_same_rows(out, [row] if kept else [])


@pytest.mark.parametrize("row,kept", [
    (("a", "b", 3), True), ((None, "b", 3), False), (("a", None, 1), False), (("a", "b", 1), True),
    (("a", None, 3), True), (("a", "b", 2), False), (("a", None, None), False),
])
def test_optional_filters(spark, row, kept):
    out = prepare.apply_optional_filters(make_df(spark, [row], "a string, b string, status int"), CFG)
    assert_same_rows(out, [row] if kept else [])


SCHEMA7 = "a int, b int, status int, t int, o1 int, o2 int, v boolean"
COLS = ["a", "b", "status", "t", "o1", "o2", "v"]


def drawn(seed, n, times=6):
    """Distinct prepared rows of a few things, crowded enough to tie, conflict and fill."""
    draw, out = random.Random(seed), set()
    while len(out) < n:
        out.add((draw.choice([31, 32, 33, None]), draw.choice([41, 42, None]), draw.choice([1, 1, 3, None]), draw.randrange(times),
                 draw.choice([None, None, 5, 6]), draw.choice([None, 8]), draw.random() < 0.7))
    return sorted(out, key=repr)


def dicts(rows):
    return [dict(zip(COLS, r)) for r in rows]


@pytest.mark.parametrize("seed", range(4))
def test_reduce_and_validate(spark, seed):
    rows, key, match = drawn(seed, 60), ["a", "status", "t"], ["b", "o1", "o2"]
    out = reduce_and_validate(make_df(spark, rows + rows[:9], SCHEMA7), CFG, key, match)
    assert_same_rows(out, [tuple(r[c] for c in COLS) for r in _pass(dicts(rows), key, match)])


def test_reduce_and_validate_rejects_overlap(spark):
    with pytest.raises(ValueError):
        reduce_and_validate(make_df(spark, drawn(0, 3), SCHEMA7), CFG, ["a", "t"], ["a", "o1"])


@pytest.mark.parametrize("hot", [None, 3])
@pytest.mark.parametrize("width", [None, 1])
@pytest.mark.parametrize("seed", range(3))
def test_mark_valid_starts(spark, seed, width, hot):
    """Both passes, whatever flag comes in, with buckets that cut times and ties or not."""
    rows = [r for r in drawn(seed, 70) if r[0] is not None]
    out = mark_valid_starts(make_df(spark, rows, SCHEMA7), CFG.with_split_width(width).with_hot_keys(hot))
    assert out.columns == COLS
    flagged = [dict(r, v=r["status"] == 1 and r["b"] is not None) for r in dicts(rows)]
    passed = _pass(_pass(flagged, ["a", "t"], ["o1", "o2", "b"]), ["b", "t"], ["o1", "o2", "a"])
    assert_same_rows(out, [tuple(r[c] for c in COLS) for r in passed])


@pytest.mark.parametrize("reasons", [list(EndReason), [EndReason.NEXT_END_NULL, EndReason.NEXT_START_SAME_MATCH]])
@pytest.mark.parametrize("width", [None, 1])
@pytest.mark.parametrize("seed", range(3))
def test_end_candidates(spark, seed, width, reasons):
    """One row a candidate of either direction, one without where there is none."""
    one = {}  # rows that differ in the flag only have no order
    for r in drawn(seed, 60):
        one.setdefault(r[:6], r)
    rows = list(one.values())
    out = end_candidates(make_df(spark, rows, SCHEMA7), CFG.with_split_width(width).with_end_reasons(reasons))
    assert out.columns == [*COLS, "start_time", "end_reason_ordinal", "end_reason_name", "end_time"]
    ds, allowed = dicts(rows), {r.value for r in reasons}
    by_a, by_b = _direction(ds, "a", "b", ["o1", "o2"], allowed), _direction(ds, "b", "a", ["o1", "o2"], allowed)
    expected, kinds = [], set()
    for i, r in enumerate(rows):
        start = r[3] if r[2] == 1 else None
        found = {d[i] for d in (by_a, by_b) if i in d}
        kinds |= {k for _, k in found}
        expected += [(*r, start, k, EndReason(k).name, t) for t, k in found] or [(*r, start, None, None, None)]
    assert kinds <= allowed and len(kinds) >= min(4, len(allowed) - 1)
    assert_same_rows(out, expected)


def test_choose_final_end(spark):
    """The earliest end, then the first reason; rows of a start that share the end stay."""
    schema, draw = SCHEMA7 + ", start_time int, end_reason_ordinal int, end_reason_name string, end_time int", random.Random(3)
    inp = []
    for _ in range(150):
        start, reason = draw.randrange(4), draw.choice([None, 1, 2, 3, 4, 5, 6])
        inp.append((draw.choice([51, 52]), draw.choice([61, None]), 1, start, draw.choice([7, None]), None, True, start,
                    reason, reason and EndReason(reason).name, reason and start + draw.randrange(5)))
    out = choose_final_end(make_df(spark, inp, schema), CFG)
    assert out.columns == [*COLS, "start_time", "final_end_time", "final_end_reason"]
    expected = set()
    for r in inp:
        ends = [(x[10], x[8]) for x in inp if x[10] is not None and (x[0], x[1], x[7]) == (r[0], r[1], r[7])]
        if r[10] is not None and r[10] == min(ends)[0]:
            expected.add((*r[:8], r[10], EndReason(min(ends)[1]).name))
    assert_same_rows(out, expected)


@pytest.mark.parametrize("hot", [None, 4])
@pytest.mark.parametrize("width", [None, 2, 9])
def test_connect_ranges(spark, width, hot):
    """Chains of several pairs, with gaps, in any order of input."""
    schema, draw = SCHEMA7 + ", start_time int, final_end_time int, final_end_reason string", random.Random(width)
    inp, expected = [], []
    for a, b in ((71, 81), (71, 82), (72, 81), (73, 83)):
        at = draw.randrange(3)
        for _ in range(draw.randrange(1, 6)):
            head, o1 = at, draw.choice([None, 4])
            for k in range(draw.randrange(1, 7)):
                end = at + draw.randrange(1, 6)
                why = draw.choice(list(EndReason)).name
                inp.append((a, b, 1, at, o1 if k == 0 else 9, None, True, at, end, why))
                at = end
            expected.append((a, b, 1, head, o1, None, True, head, at, why))
            at += draw.randrange(1, 8)
    out = connect_ranges(make_df(spark, inp, schema), CFG.with_split_width(width).with_hot_keys(hot))
    assert_same_rows(out, expected)


def test_connect_long_chain_across_many_buckets(spark):
    """A chain of 200 back-to-back ranges cut into buckets of width 3, with
    gaps: islands must come out whole whatever the cut."""
    schema = SCHEMA7 + ", start_time int, final_end_time int, final_end_reason string"
    inp, expected = [], []
    s = 0
    for island in range(5):
        head = s
        n = 40 - island * 7
        for i in range(n):
            inp.append((9, 9, 1, s, 1, 1, True, s, s + 1 + (i % 3), f"R{island}_{i}"))
            s = s + 1 + (i % 3)
        expected.append((9, 9, 1, head, 1, 1, True, head, s, f"R{island}_{n - 1}"))
        s += 5 + island
    for width in (None, 1, 3, 50):
        out = connect_ranges(make_df(spark, inp, schema), CFG.with_split_width(width))
        assert_same_rows(out, expected)
