import datetime as dt


def day(text):
    return dt.date.fromisoformat(text)


def ts(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def one(df, **where):
    for column, value in where.items():
        df = df.filter(df[column] == value)
    found = df.collect()
    assert len(found) == 1, found
    return found[0].asDict()
