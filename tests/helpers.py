from landfall.sources import LANDING_SCHEMA


def land(spark, *responses):
    """Landing rows from (endpoint, body) or (endpoint, entity id, body)."""
    rows = [
        (r[0], r[1] if len(r) == 3 else None, seq, r[-1]) for seq, r in enumerate(responses)
    ]
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
