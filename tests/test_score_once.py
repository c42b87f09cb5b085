"""A scored record's numbers are read once; the streaming query joins its training listing once."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer

from pricelens.config import ColumnRoles
from pricelens.operators.score import score
from pricelens.operators.validate import allowed_from_lists, validate

ROLES = ColumnRoles(target=("make",), ordinal=(), onehot=(), numeric=("year", "km"), label="price", keys=("id",))


def records(spark):
    return spark.createDataFrame([(1, "a", "2000", " 1.5"), (2, "c", "2001", "3"), (3, "a", "1949", "1d"), (4, None, None, "NaN")],
                                 "id long, make string, year string, km string")


def test_scored_numbers_are_read_once(spark):
    model = PipelineModel(stages=[SQLTransformer(statement="SELECT *, km / year AS prediction FROM __THIS__")])
    scored = score(records(spark), model, ROLES, allowed=allowed_from_lists(spark, {"make": ["a", "b"]}))
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == len(ROLES.numeric)
    got = {r.id: (r.year, r.km, r.log_pred, r.error) for r in scored.collect()}
    assert got == {1: (2000.0, 1.5, 1.5 / 2000, None), 2: (2001.0, 3.0, None, "make:not_allowed"),
                   3: (1949.0, None, None, "year:below_1950,km:not_numeric"), 4: (None, None, None, "make:missing,year:missing,km:not_numeric")}


def test_validated_records_keep_their_text(spark):
    checked = validate(records(spark), ROLES, allowed_from_lists(spark, {"make": ["a", "b"]}))
    assert dict(checked.dtypes)["km"] == "string" and {r.km for r in checked.collect()} == {" 1.5", "3", "1d", "NaN"}


def test_stream_query_joins_its_training_rows_once(spark, monkeypatch):
    from pricelens.plans import catalog
    reads = []
    listings = catalog.listings
    monkeypatch.setattr(catalog, "listings", lambda *a: reads.append(1) or listings(*a))
    out = catalog.QUERIES["score_stream"](spark, "/root/testdata/sf0.001")
    assert len(reads) == 1 and out.where("not price_sound").count() == 0
