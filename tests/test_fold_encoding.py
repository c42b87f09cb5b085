"""The encoders of all folds come from one count and one lookup per column, with the values of a fit per fold."""

import pytest
from pyspark.sql import functions as F

from pricelens.config import ColumnRoles
from pricelens.operators import train as tr
from pricelens.operators.encode import feature_pipeline, fold_encoded

ROLES = ColumnRoles(target=("make", "name"), ordinal=("gear",), onehot=("fuel",), numeric=("year", "km"), label="price",
                    keys=("id",))
# Nulls, a category of one fold only (name n7, fuel x), one of two rows, repeated rows.
ROWS = [(i, i % 3, ["a", "b", None][i % 7 % 3], f"n{i % 5}" if i != 7 else "n7", "m" if i % 4 else None,
         "x" if i % 3 == 2 and i < 9 else ["p", "d"][i % 2], 2000 + i % 9, None if i % 11 == 0 else i * 1.5, 3 + (i * 37 % 100) / 100)
        for i in range(60)] + [(60, 0, "a", "n1", "m", "p", 2001, 1.0, 3.5)] * 2


def rows_of(spark):
    return spark.createDataFrame(ROWS, "id long, fold int, make string, name string, gear string, fuel string, year int, "
                                       "km double, log_price double").repartition(3)


@pytest.mark.parametrize("method,order,small", [("additive", "frequency", True), ("sigmoid", "alphabet", True),
                                                ("additive", "frequency", False)])
def test_all_folds_as_fitted_alone(spark, method, order, small):
    df = rows_of(spark).cache()
    bound = {} if small else {"max_broadcast_bytes": 0}
    table, features = fold_encoded(df, ROLES, "fold", [0, 1, 2], method=method, ordinal_order=order, **bound)
    assert table.count() == len(ROWS)
    for k in range(3):
        alone = feature_pipeline(ROLES, method=method, ordinal_order=order).fit(df.where(F.col("fold") != k))
        for side in (F.col("fold") == k, F.col("fold") != k):
            got, want = (sorted((r.log_price, str(r.features.size), *[repr(round(x, 9)) for x in r.features.toArray()])
                                for r in found.collect())
                         for found in (features(table.where(side), k), alone.transform(df.where(side))))
            assert got == want


def test_folds_fit_no_encoders_of_their_own(spark, monkeypatch):
    fits = []
    fit = tr.fit_encoders
    monkeypatch.setattr(tr, "fit_encoders", lambda *a, **how: fits.append(1) or fit(*a, **how))
    df = rows_of(spark).drop("fold", "log_price").na.fill(1.0, ["km"]).withColumn("price", F.col("year") * 10.0 + F.col("id"))
    model, metrics = tr.cross_validate(df, ROLES, folds=3, trees=2, depth=2)
    assert len(fits) == 1 and model is not None  # the refit's
    assert metrics.where("fold >= 0").agg(F.sum("n")).first()[0] == len(ROWS)
