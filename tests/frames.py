"""Small frames with zone-free timestamps."""

import datetime as dt


def at(text):
    return None if text is None else dt.datetime.fromisoformat(text)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
