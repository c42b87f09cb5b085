"""Column roles and fixed values.

A ``ColumnRoles`` names which column plays which part (target-encoded, ordinal,
one-hot, numeric, label, row key). It is defined once and shared by training,
profiling and scoring so the feature order can never drift between them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ColumnRoles:
    target: tuple[str, ...]
    ordinal: tuple[str, ...]
    onehot: tuple[str, ...]
    numeric: tuple[str, ...]
    label: str
    keys: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    label_col: str = "log_price"

    @property
    def categorical(self) -> tuple[str, ...]:
        return self.target + self.ordinal + self.onehot

    @property
    def features(self) -> tuple[str, ...]:
        """Raw input columns a scoring record must carry."""
        return self.target + self.ordinal + self.onehot + self.numeric


# ---------------------------------------------------------------------------
# Column names of the raw used-car listing CSV (header row, natural
# order), the columns the jobs throw away, and the role lists of the training job.
# ---------------------------------------------------------------------------
CAR_COLUMNS = [
    "Company Name", "Model Name", "Price", "Model Year", "Mileage", "Engine Type",
    "Engine Capacity", "Color", "Assembly", "Body Type", "Transmission Type",
    "Registration Status",
]
CAR_DROPPED = ["_c0", "Location"]
CAR_ROLES = ColumnRoles(
    target=("Company Name", "Model Name", "Color"),
    ordinal=("Assembly", "Transmission Type", "Registration Status"),
    onehot=("Engine Type", "Body Type"),
    numeric=("Model Year", "Mileage", "Engine Capacity"),
    label="Price",
    drop=tuple(CAR_DROPPED),
)

# ---------------------------------------------------------------------------
# The closed choice lists of the scoring form (natural order).
# The model-name list (~200 entries) is not transcribed; it is derived from the
# training data by ``pricelens.operators.validate.allowed_from_data``.
# ---------------------------------------------------------------------------
CAR_ALLOWED = {
    "Company Name": [
        "Toyota", "Suzuki", "Honda", "Mitsubishi", "Nissan", "Daihatsu", "Audi",
        "Chevrolet", "Mercedes", "Hyundai", "Daewoo", "BMW", "FAW", "Range", "DFSK",
        "KIA", "Lexus", "United", "SsangYong", "Mazda", "Subaru", "Porsche", "Chery",
        "Fiat", "Land", "MINI", "Hummer", "Jeep", "Jaguar", "Adam", "Volvo",
    ],
    "Engine Type": ["Petrol", "Diesel", "Hybrid"],
    "Color": [
        "Silver", "White", "Black", "Beige", "Grey", "Brown", "Pink", "Assembly",
        "Maroon", "Burgundy", "Gold", "Blue", "Red", "Indigo", "Unlisted", "Green",
        "Turquoise", "Orange", "Bronze", "Purple", "Yellow", "Navy", "Magenta", "Wine",
    ],
    "Assembly": ["Imported", "Local"],
    "Body Type": ["Hatchback", "Sedan", "SUV", "Cross Over", "Van", "Mini Van"],
    "Transmission Type": ["Automatic", "Manual"],
    "Registration Status": ["Un-Registered", "Registered"],
}
# Model-year floor of the form, target smoothing of the training job,
# rare-category threshold of the profiling notebook, display conversion rate, clip
# bounds of the violin cell, forest and split settings of the training job.
MIN_MODEL_YEAR = 1950
ADDITIVE_SMOOTHING = 5.0
SIGMOID_SMOOTHING = 5.0
SIGMOID_MIN_SAMPLES_LEAF = 20
RARE_THRESHOLD = 200
FX_RATE = 0.0036
PRICE_CLIP = (100000.0, 30000000.0)
FOREST_TREES = 200
FOREST_DEPTH = 12
FOREST_SEED = 42
SPLIT_SEED = 40
TEST_SHARE = 0.2
CV_FOLDS = 10


# ---------------------------------------------------------------------------
# The stand-in listing table built from the driver's TPC-H-like tables.
# ---------------------------------------------------------------------------
LISTING_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LISTING_ROLES = ColumnRoles(
    target=("company", "model", "color"),
    ordinal=("assembly", "transmission", "registration"),
    onehot=("engine_type", "body_type"),
    numeric=("model_year", "mileage", "engine_capacity"),
    label="price",
    keys=LISTING_KEYS,
)
LISTING_NUMERIC = ("price", "model_year", "mileage", "engine_capacity")
