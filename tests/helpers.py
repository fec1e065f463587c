"""What several test files share."""

SF_DIR = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
