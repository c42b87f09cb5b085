"""SQL texts shared by the oracle queries (DuckDB dialect, ANSI where possible)."""

KEYS_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

LISTINGS = """listings AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         p.p_brand AS company, p.p_name AS model, c.c_mktsegment AS color,
         l.l_returnflag AS engine_type, p.p_type AS body_type, l.l_linestatus AS assembly,
         o.o_orderstatus AS transmission,
         CASE WHEN l.l_discount > 0.05 THEN 'Registered' ELSE 'Un-Registered' END AS registration,
         CAST(year(o.o_orderdate) AS INTEGER) AS model_year, o.o_totalprice AS mileage,
         p.p_size AS engine_capacity, l.l_extendedprice AS price
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey)"""

_DIRTY_COLS = """l_orderkey, l_linenumber, l_partkey, l_suppkey, company, model,
         CASE WHEN color <> 'BUILDING' THEN color END AS color,
         engine_type, body_type, assembly, transmission, registration,
         model_year, mileage, engine_capacity, price"""

DIRTY = LISTINGS + f""",
dirty AS (
  SELECT {_DIRTY_COLS},
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, '0') AS row_id
  FROM listings
  UNION ALL
  SELECT {_DIRTY_COLS},
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, '1') AS row_id
  FROM listings WHERE l_linenumber = 1)"""

LABELLED = LISTINGS + """,
lab AS (SELECT *, CASE WHEN price > 0 THEN log10(price) END AS log_price FROM listings)"""

SPLIT = LABELLED + """,
split AS (
  SELECT *,
         CAST(('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8)) AS BIGINT) < 0.2 * 4294967296 AS is_test,
         CAST(('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8)) AS BIGINT) < 0.005 * 4294967296 AS is_small,
         CAST(CAST(('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 9, 8)) AS BIGINT) % 10 AS INTEGER) AS fold
  FROM lab),
train AS (SELECT * FROM split WHERE NOT is_test),
test AS (SELECT * FROM split WHERE is_test)"""


def target_stats(source: str, cols: list[str], label: str = "log_price") -> str:
    """UNION ALL of per-column (feature, category, mean, n)."""
    parts = [f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, avg({label}) AS m, "
             f"count({label}) AS n FROM {source} GROUP BY {c}" for c in cols]
    return "\n  UNION ALL ".join(parts)


def freq_codes(source: str, cols: list[str], alphabetical: bool = False) -> str:
    """(feature, category, code) like a frequency-desc (ties alphabetical) indexer."""
    parts = []
    for c in cols:
        order = c if alphabetical else f"count(*) DESC, {c}"
        parts.append(f"SELECT '{c}' AS feature, {c} AS category, "
                     f"row_number() OVER (ORDER BY {order}) - 1 AS code "
                     f"FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}")
    return "\n  UNION ALL ".join(parts)
