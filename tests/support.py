"""What several test modules share."""

SF = "/root/testdata/sf0.001"


def same(left, right):
    """Whether two pandas frames hold the same columns and rows, in any order."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a, b = (sorted(map(tuple, f[columns].astype(str).itertuples(index=False))) for f in (left, right))
    return a == b
