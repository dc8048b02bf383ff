"""Shared by the tests."""

from pathlib import Path

DATA = Path("/root/testdata/sf0.001")


def same_rows(got, want):
    """Rows of a DataFrame and of a DuckDB result, by column name, floats rounded."""

    def tidy(v):
        return round(v, 6) if isinstance(v, float) else tuple(map(tidy, v)) if isinstance(v, (list, tuple)) else v

    names = [x[0] for x in want.description]
    assert sorted(got.columns) == sorted(names)
    cols = sorted(names)
    order = [names.index(c) for c in cols]
    a = sorted((tuple(map(str, map(tidy, r))) for r in got.select(*cols).collect()))
    b = sorted((tuple(str(tidy(r[i])) for i in order) for r in want.fetchall()))
    assert a == b
