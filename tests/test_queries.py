"""Registered queries of the core operators against their SQL on the smallest tables."""

import duckdb
import pytest

from millrace.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows_of(frame):
    columns = sorted(frame.columns)
    clean = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(map(repr, clean.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.ORACLES:
        want = duck.execute(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
    else:
        assert len(got) > 0


def test_csv_round_trip_of_odd_texts(spark, tmp_path):
    """Blanks at the ends, line ends and texts that look like missing cells, in every column of text."""
    odd = ["", " ", "  a", "a \n", "\ta", "\r\n", "\ra", "\x01a", '\x00"\x00\n', "NaN", "null", "\\NaN", "\\", "\\\\", ' "q" ', '"', "a\\", None]
    rows = [(4 * k + at, text, odd[(k + at) % len(odd)]) for k, text in enumerate(odd) for at in range(4)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["csv_round_trip"](spark, str(tmp_path)).toPandas()
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert rows_of(got) == rows_of(con.execute(catalog.ORACLES["csv_round_trip"]).df())


def test_short_layers_of_groups_whose_target_is_whole(spark, tmp_path):
    """0.7 of 90, 170, 180, 330 and 1,310 units are whole numbers that doubles miss."""
    rows = [(n * 10_000 + k, f"g{n}", "s") for n in (90, 170, 180, 330, 1310, 89, 91) for k in range(n)]
    spark.createDataFrame(rows, "doc_id bigint, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["short_layers"](spark, str(tmp_path)).toPandas()
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert rows_of(got) == rows_of(con.execute(catalog.ORACLES["short_layers"]).df())
