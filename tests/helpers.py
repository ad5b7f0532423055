"""Helpers of the test files."""

import random

SEED = 20240601
print(f"test shuffle seed: {SEED}")


def make_df(spark, rows, schema, seed=SEED):
    """Rows in a fixed, printed-seed shuffled order, so tests do not depend on input order."""
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, schema)


def assert_same_rows(actual, expected_rows, columns=None):
    """Multiset equality of rows (order-free), on the given column order."""
    cols = columns or actual.columns
    got = sorted((tuple(r[c] for c in cols) for r in actual.collect()), key=repr)
    exp = sorted((tuple(r) for r in expected_rows), key=repr)
    assert got == exp, f"\n got: {got}\n exp: {exp}"
