"""Comparing results."""


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def by_key(df, key, *columns):
    """Key to a value, or to a tuple of values."""
    found = {}
    for r in df.collect():
        assert r[key] not in found, f"{r[key]} twice"
        found[r[key]] = r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns)
    return found
