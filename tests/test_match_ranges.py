"""End-to-end goldens, quirk goldens and randomized checks of the match-range operator."""

import datetime
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import assert_same_rows, make_df
from matchspan.config import EndReason, MatchConfig, UpdatePolicy
from matchspan.operators.ranges import _with_buckets, chosen_ranges, match_ranges, prepared_rows, unexpected_statuses
from matchspan.operators.timeline import hot_edges
from model import model

SCHEMA = "a int, b int, status string, t int, o1 int, o2 int"
NAMES = {"start": 1, "update": 2, "end": 3}
ASSUME = MatchConfig("a", "b", "t", "status", NAMES, ["o1", "o2"], "v", update_policy=UpdatePolicy.ASSUME_START)
IGNORE = MatchConfig("a", "b", "t", "status", NAMES, ["o1", "o2"], "v")
OUT = ["a", "b", "status", "t", "o1", "o2", "v", "start_time", "final_end_time", "final_end_reason"]


def run(spark, rows, cfg, width=None):
    return match_ranges(make_df(spark, rows, SCHEMA), cfg.with_split_width(width))


HOT = {"fixed": (None, 4096), "hot-2": (2, 4096), "hot-3-cap-4": (3, 4)}


# a desk (a) lent to people (b), by hour
E2E = [
    ([(7, 301, "start", 10, None, 2), (7, 301, "end", 16, 9, 2)],
     [(7, 301, 1, 10, None, 2, True, 10, 16, "NEXT_END_FOR_SAME_MATCH")]),
    ([(7, 301, "update", 10, None, 2), (7, 302, "end", 12, None, None), (8, 301, "start", 15, 4, None)],
     [(7, 301, 1, 10, None, 2, True, 10, 12, "NEXT_END_MATCH_BREAK")]),
    ([(7, 301, "start", h, 3, None) for h in (2, 4, 8)] + [(7, 302, "update", 9, 3, None), (7, None, "end", 11, None, None)],
     [(7, 301, 1, 2, 3, None, True, 2, 9, "NEXT_START_MATCH_BREAK"), (7, 302, 1, 9, 3, None, True, 9, 11, "NEXT_END_NULL")]),
]


@pytest.mark.parametrize("width", [None, 1, 5])
@pytest.mark.parametrize("rows,expected", E2E, ids=["plain", "broken-on-both-sides", "chain-and-hand-over"])
def test_end_to_end_assume_start(spark, rows, expected, width):
    out = run(spark, rows, ASSUME, width)
    assert out.columns == OUT
    assert_same_rows(out, expected)


def _r(a, b, s, t, o1=None, o2=None):
    return (a, b, s, t, o1, o2)


NEW_GOLDENS = [
    ("N1-open-range", IGNORE, [_r(0, 0, "start", 1)], []),
    ("N2-merge", IGNORE, [_r(0, 0, "start", 1), _r(0, 0, "start", 2), _r(0, 0, "end", 3)],
     [(0, 0, 1, 1, None, None, True, 1, 3, "NEXT_END_FOR_SAME_MATCH")]),
    ("N3-hand-over", IGNORE, [_r(0, 0, "start", 1), _r(0, 0, "end", 5), _r(0, 1, "start", 5), _r(0, 1, "end", 9)],
     [(0, 0, 1, 1, None, None, True, 1, 5, "NEXT_END_FOR_SAME_MATCH")]),
    ("N4-end-fills-start", IGNORE, [_r(0, 0, "start", 1), _r(0, 0, "end", 1, o1=7), _r(0, 0, "end", 3, o1=7)],
     [(0, 0, 1, 1, 7, None, True, 1, 3, "NEXT_END_FOR_SAME_MATCH")]),
    ("N5-zero-length", ASSUME, [_r(0, 0, "start", 1), _r(0, None, "update", 1), _r(0, 0, "end", 3)],
     [(0, 0, 1, 1, None, None, True, 1, 1, "NEXT_START_MATCH_NULL")]),
    ("N6-unknown-hides-end", ASSUME, [_r(0, 0, "start", 1), _r(0, 0, "other", 2), _r(0, 0, "end", 3)], []),
    ("N7-unknown-ignored", IGNORE, [_r(0, 0, "start", 1), _r(0, 0, "other", 2), _r(0, 0, "end", 3)],
     [(0, 0, 1, 1, None, None, True, 1, 3, "NEXT_END_FOR_SAME_MATCH")]),
    ("N8-directions-disagree", IGNORE, [_r(0, 5, "start", 1), _r(0, 3, "end", 2), _r(0, 5, "end", 2)],
     [(0, 5, 1, 1, None, None, True, 1, 2, "NEXT_END_FOR_SAME_MATCH")]),
    ("N9-all-reasons", IGNORE, [_r(0, 0, "start", 1), _r(0, 1, "end", 2), _r(0, 0, "end", 4)],
     [(0, 0, 1, 1, None, None, True, 1, 2, "NEXT_END_MATCH_BREAK")]),
    ("N10-one-reason", IGNORE.with_end_reasons([EndReason.NEXT_END_FOR_SAME_MATCH]),
     [_r(0, 0, "start", 1), _r(0, 1, "end", 2), _r(0, 0, "end", 4)],
     [(0, 0, 1, 1, None, None, True, 1, 4, "NEXT_END_FOR_SAME_MATCH")]),
    ("N11-null-a", IGNORE, [_r(None, 0, "start", 1), _r(0, 0, "start", 2), _r(None, 0, "end", 3), _r(0, 0, "end", 4)],
     [(0, 0, 1, 2, None, None, True, 2, 4, "NEXT_END_FOR_SAME_MATCH")]),
]


@pytest.mark.parametrize("name,cfg,rows,expected", NEW_GOLDENS, ids=[g[0] for g in NEW_GOLDENS])
def test_new_goldens(spark, name, cfg, rows, expected):
    assert_same_rows(run(spark, rows, cfg, width=1), expected)
    assert model(
        [dict(zip(["a", "b", "status", "t", "o1", "o2"], r)) for r in rows], cfg
    ) == set(expected)


def test_n12_undeclared_column_is_rejected(spark):
    df = spark.createDataFrame([(0, 0, "start", 1, 1, 1, "x")], SCHEMA + ", payload string")
    with pytest.raises(ValueError, match="payload"):
        match_ranges(df, IGNORE)


def test_config_errors():
    with pytest.raises(ValueError):
        MatchConfig("a", "a", "t", "status", NAMES, ["o1"], "v")
    with pytest.raises(ValueError):
        MatchConfig("a", "b", "t", "status", NAMES, ["o1"], "v", end_reasons=[7])
    with pytest.raises(ValueError):
        MatchConfig("a", "b", "t", "status", {"start": 9}, [], "v")


def test_status_type_mismatch(spark):
    df = spark.createDataFrame([(0, 0, 1, 1, 1, 1)], "a int, b int, status int, t int, o1 int, o2 int")
    with pytest.raises(ValueError, match="key type"):
        match_ranges(df, IGNORE)


def _random_log(rng, case, n):
    rows = []
    for _ in range(n):
        a = rng.choice([0, 1, 2, 2, None]) if rng.random() > 0.05 else None
        b = rng.choice([0, 1, 2, None])
        rows.append((
            None if a is None else case * 10 + a,
            None if b is None else case * 10 + b,
            rng.choice(["start", "start", "update", "end", "end", "other", None]),
            rng.choice([0, 1, 2, 3, 4, 5, 6, 7, None]) if rng.random() > 0.03 else None,
            rng.choice([None, 1, 1, 2]),
            rng.choice([None, None, 1]),
        ))
    return rows


CONFIGS = {
    "ignore": IGNORE,
    "ignore-filters": IGNORE.filter_null_a().filter_null_b_on_start(),
    "assume": ASSUME,
    "assume-filters": ASSUME.filter_null_b_on_start(),
    "subset": ASSUME.with_end_reasons([EndReason.NEXT_END_FOR_SAME_MATCH, EndReason.NEXT_START_MATCH_BREAK,
                                       EndReason.NEXT_END_NULL]),
}


@pytest.mark.parametrize("hot", list(HOT))
@pytest.mark.parametrize("width", [None, 1, 3])
@pytest.mark.parametrize("cfg_name", list(CONFIGS))
def test_random_logs_against_model(spark, cfg_name, width, hot):
    """Many independent small logs per Spark run: each case uses its own key
    range, so cases never interact.  ``hot`` makes keys with more than a few
    rows hot, so they get their own bucket widths (capped to a few keys)."""
    if hot != "fixed" and width == 3:
        pytest.skip("covered by the other widths")
    rng = random.Random(sum(map(ord, cfg_name + hot)) * 31 + (width or 0))
    rows = []
    for case in range(60):
        rows += _random_log(rng, case, rng.randint(3, 14))
    cfg = CONFIGS[cfg_name].with_hot_keys(*HOT[hot])
    expected = model([dict(zip(["a", "b", "status", "t", "o1", "o2"], r)) for r in rows], cfg)
    got = run(spark, rows, cfg, width)
    got_rows = {tuple(r[c] for c in OUT) for r in got.collect()}
    assert got.count() == len(got_rows)
    assert got_rows == expected


@pytest.mark.parametrize("hot", list(HOT))
def test_timestamp_time_across_buckets(spark, hot):
    """Time as TIMESTAMP_NTZ, cut every hour: ranges and merges cross buckets."""
    base = datetime.datetime(2024, 1, 1)
    rng = random.Random(5)
    rows = []
    for case in range(40):
        for a, b, s, t, o1, o2 in _random_log(rng, case, 10):
            rows.append((a, b, s, None if t is None else base + datetime.timedelta(minutes=37 * t), o1, o2))
    schema = "a int, b int, status string, t timestamp_ntz, o1 int, o2 int"
    cfg = ASSUME.with_split_width(1).with_hot_keys(*HOT[hot])
    got = match_ranges(make_df(spark, rows, schema), cfg)
    expected = model([dict(zip(["a", "b", "status", "t", "o1", "o2"], r)) for r in rows], cfg)
    assert {tuple(r[c] for c in OUT) for r in got.collect()} == expected


SHAPES = {
    # (a, b, t) of row i of a key that holds a third of the rows and more
    "burst": lambda i, r: (1, r.randrange(40), 5000 + r.randrange(300) if r.random() < 0.8 else r.randrange(10_000)),
    "outlier": lambda i, r: (1, r.randrange(40), i if i else 10**9),
    "one-time": lambda i, r: (1, r.randrange(700), 77 if i % 3 else i),
    "two-times": lambda i, r: (1, r.randrange(700), 77 + i % 2),
}


@pytest.mark.parametrize("time", ["int", "string", "double"])
@pytest.mark.parametrize("shape", list(SHAPES))
def test_hot_key_buckets_are_even(spark, shape, time):
    """Buckets of a hot key hold at most twice the mean, whatever its times are, and
    the result is the model's (cut ties included)."""
    draw = random.Random(shape)
    named = {"int": lambda t: t, "string": lambda t: f"{t:012d}", "double": float}[time]
    rows = []
    for i in range(3000):
        a, b, t = SHAPES[shape](i, draw)
        rows.append((a, b, draw.choice(["start", "end", "end", "update"]), named(t), draw.choice([None, 1]), None))
    rows += [(100 + i, 100 + i, s, named(t), None, None) for i in range(200) for s, t in (("start", 3), ("end", 9))]
    schema = SCHEMA.replace("t int", f"t {time}")
    cfg = ASSUME.with_hot_keys(100)
    prepared = prepared_rows(make_df(spark, rows, schema), cfg)
    x, edges, _ = _with_buckets(prepared, cfg)
    sizes = [r["count"] for r in x.where("a = 1").groupBy("_tba").count().collect()]
    assert len(sizes) > 5 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert edges.ties == (shape in ("one-time", "two-times"))
    expected = model([dict(zip(["a", "b", "status", "t", "o1", "o2"], r)) for r in rows], cfg)
    assert {tuple(r[c] for c in OUT) for r in match_ranges(make_df(spark, rows, schema), cfg).collect()} == expected


def test_cut_ties_on_both_sides(spark):
    """Large ties on (a, t) and (b, t) with valid starts, conflicts and fills among them."""
    draw, rows = random.Random(4), []
    for case in range(40):
        a = case
        for _ in range(30):
            rows.append((a, 9 if case % 2 else draw.choice([8, 9]), draw.choice(["start", "end", "other"]), draw.choice([1, 1, 1, 2, 3]),
                         draw.choice([None, 5]), draw.choice([None, None, case % 3])))
        rows += [(7000, 100 + k, "end", 1, None, None) for k in range(20)] + [(7000, 5, "start", 2, None, None)]
        rows += [(900 + case, 77, "start", 4, 1 if case < 39 else None, None)]
    for hot in (2, 5, 40):
        cfg = ASSUME.with_hot_keys(hot)
        x, edges_a, edges_b = _with_buckets(prepared_rows(make_df(spark, rows, SCHEMA), cfg), cfg)
        assert edges_b.ties and (hot > 5 or edges_a.ties)
        expected = model([dict(zip(["a", "b", "status", "t", "o1", "o2"], r)) for r in rows], cfg)
        got = match_ranges(make_df(spark, rows, SCHEMA), cfg)
        assert {tuple(r[c] for c in OUT) for r in got.collect()} == expected and got.count() == len(expected)


def test_many_edges_are_picked_in_linear_time(spark):
    """Two hot keys of 20,000 rows with buckets of 5: the edges are those of the sorted
    rows, some inside ties, and are found without work for each pair of edges."""
    rows = [(a, (i // 7 if a else i), i) for a in (0, 1) for i in range(20_000)] + [(2, 5, 5)]
    x = spark.createDataFrame(rows, "a int, t int, b int")
    began = time.monotonic()
    [edges] = hot_edges(x, [("a", [F.col("t"), F.col("b")])], 5, 4096)
    got = {r["a"]: [(e["k0"], e["k1"], e["whole"]) for e in r["_edges"]] for r in edges.table.collect()}
    assert time.monotonic() - began < 60
    expected = {}
    for a in (0, 1):
        own = sorted(r[1:] for r in rows if r[0] == a)
        picked = [own[j * len(own) // 4000] for j in range(1, 4000)]
        times = Counter(t for t, _ in picked)
        expected[a] = [(t, None, True) if times[t] == 1 else (t, b, False) for t, b in picked]
    assert edges.ties and got == expected


def test_payload_of_the_first_start_row(spark):
    """Starts of one (a, b, t) differ in payload; the one that sorts first is taken."""
    schema = SCHEMA + ", note string, `w.x` double, m map<string,int>"
    draw, rows = random.Random(12), []
    for case in range(60):
        for r in _random_log(draw, case, 12):
            rows.append((*r, draw.choice([None, "x", "y", "z" * 2000]), draw.choice([None, 1.5, float("nan")]), draw.choice([None, {}, {"k": case}])))
    payload = ["note", "w.x", "m"]
    for cfg in (ASSUME, IGNORE.filter_null_b_on_start(), ASSUME.with_hot_keys(3)):
        plain = model([dict(zip(["a", "b", "status", "t", "o1", "o2"], r)) for r in rows], cfg)
        got = match_ranges(make_df(spark, rows, schema), cfg, payload=payload)
        assert got.columns == OUT + payload
        starts = ("start", "update") if cfg.update_policy is UpdatePolicy.ASSUME_START else ("start",)
        order = lambda p: tuple((v is not None, (repr(v) if isinstance(v, dict) else (v != v, v if v == v else 0) if isinstance(v, float) else v) if v is not None else 0) for v in p)
        want = set()
        for r in plain:
            own = [x[6:] for x in rows if x[0] == r[0] and x[1] == r[1] and x[3] == r[7] and x[2] in starts]
            want.add((*r, repr(min(own, key=lambda p: order((p[0], p[1], None if p[2] is None else {str(k): v for k, v in p[2].items()}))))))
        assert {(*tuple(x)[:10], repr(tuple(x)[10:])) for x in got.collect()} == want
    df = make_df(spark, rows, schema)
    assert match_ranges(df.where("false"), ASSUME, payload=payload).count() == 0
    for bad in (["nope"], ["t"], ["note", "note"]):
        with pytest.raises(ValueError):
            match_ranges(df, ASSUME, payload=bad)


def test_payload_is_shuffled_once_and_source_scanned_once_for_the_analysis(spark):
    df = make_df(spark, [(0, 0, "start", 1, 1, 1, "p"), (0, 0, "end", 3, 1, 1, "q")], SCHEMA + ", note string")
    plan = match_ranges(df, IGNORE, payload=["note"])._jdf.queryExecution().executedPlan().toString()
    assert sum("note" in ln for ln in plan.splitlines() if "Exchange hash" in ln or "SortAggregate" in ln and "partial" in ln) >= 1
    assert "note" not in chosen_ranges(df.drop("note"), IGNORE)._jdf.queryExecution().executedPlan().toString()


def test_plan_has_three_full_exchanges_before_merge(spark):
    rows = [(0, 0, "start", 1, 1, 1), (0, 0, "end", 3, 1, 1)]
    ranges = chosen_ranges(make_df(spark, rows, SCHEMA), IGNORE)
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    # Full-data shuffles: (a, bucket), (b, bucket, spread), (a, bucket).  The
    # per-bucket summaries shuffle only after a partial aggregate.
    assert plan.count("REPARTITION_BY_COL") == 3
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    merged = match_ranges(make_df(spark, rows, SCHEMA), IGNORE)
    mplan = merged._jdf.queryExecution().executedPlan().toString()
    # Ranges only, by (a, b, bucket): rows and the pruned per-bucket summary.
    assert mplan.count("REPARTITION_BY_COL") == 2


def test_underscore_column_names_pass_through(spark):
    rows = [(0, 0, "start", 1, 5), (0, 0, "end", 3, 5)]
    df = make_df(spark, rows, "a int, b int, status string, t int, _o int")
    cfg = MatchConfig("a", "b", "t", "status", NAMES, ["_o"], "v")
    out = match_ranges(df, cfg)
    assert out.columns == ["a", "b", "status", "t", "_o", "v", "start_time", "final_end_time", "final_end_reason"]
    assert_same_rows(out, [(0, 0, 1, 1, 5, True, 1, 3, "NEXT_END_FOR_SAME_MATCH")])


def test_one_hot_pair_split_finely(spark):
    """One pair with a long alternating log (the hot key), next to small ones:
    with hot-key widths its timeline is cut into many buckets."""
    rows = []
    for i in range(400):
        rows.append((1, 1 if i % 7 else 2, ["start", "end", "update"][i % 3], i, 1, None))
    for case in range(2, 30):
        rows += [(case * 10, case * 10, "start", 5, None, None), (case * 10, case * 10, "end", 9, None, None)]
    for cfg in (ASSUME.with_hot_keys(25), IGNORE.with_hot_keys(10, 2), ASSUME.with_hot_keys(None)):
        expected = model([dict(zip(["a", "b", "status", "t", "o1", "o2"], r)) for r in rows], cfg)
        got = run(spark, rows, cfg)
        assert {tuple(r[c] for c in OUT) for r in got.collect()} == expected


def test_validate_option(spark):
    rows = [(0, 0, "start", 1, None, None), (0, 0, "update", 2, None, None), (0, 0, "end", 3, None, None),
            (0, 0, "other", 4, None, None)]
    for cfg in (IGNORE, ASSUME):
        assert unexpected_statuses(make_df(spark, rows, SCHEMA), cfg).count() == 0
        assert match_ranges(make_df(spark, rows, SCHEMA), cfg, validate=True).count() == 1


@pytest.mark.parametrize("hot", list(HOT))
def test_next_event_against_brute_force(spark, hot):
    from matchspan.operators.prepare import initialize
    from matchspan.operators.ranges import next_event
    from model import _desc_nl, _nl
    rng = random.Random(11)
    rows = []
    for case in range(30):
        rows += _random_log(rng, case, rng.randint(3, 14))
    cfg = IGNORE.with_split_width(1).with_hot_keys(*HOT[hot])
    got = next_event(initialize(make_df(spark, rows, SCHEMA), cfg), cfg).collect()
    prepared = [r.asDict() for r in initialize(make_df(spark, rows, SCHEMA), cfg).collect()]
    by_a = {}
    for r in prepared:
        by_a.setdefault(r["a"], []).append(r)
    expected = []
    for rs in by_a.values():
        rs.sort(key=lambda r: (r["t"], _desc_nl(r["status"]), _nl(r["b"]), _nl(r["o1"]), _nl(r["o2"])))
        for i, r in enumerate(rs):
            n = rs[i + 1] if i + 1 < len(rs) else None
            expected.append((r["a"], r["b"], r["status"], r["t"], r["o1"], r["o2"],
                             n and n["t"], n and n["status"], n and n["b"]))
    cols = ["a", "b", "status", "t", "o1", "o2", "next_t", "next_status", "next_b"]
    assert sorted((tuple(r[c] for c in cols) for r in got), key=repr) == sorted(expected, key=repr)
