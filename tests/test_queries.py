"""Every query of the table layer gives the rows of its SQL."""

import duckdb
import pytest

from tidelake import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, data, same, name):
    same(queries.QUERIES[name](spark, data), queries.ORACLES[name])


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["dt", "orders", "total", "last_placed"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_type_roundtrip_keeps_rows_whose_id_is_no_smallint(spark, tmp_path):
    ids = [-32769, -32768, -1, 0, 32767, 32768, 44871, 2_900_000]
    spark.createDataFrame([(i, [float(i), 0.5], i % 7) for i in ids], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    sql, duck = queries.ORACLES["type_roundtrip"], duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    with pytest.raises(duckdb.ConversionException):  # the SQL itself has no rows here
        duck.execute(sql).fetchall()
    found = duck.execute(sql.replace("CAST(vec_id AS SMALLINT)", "TRY_CAST(vec_id AS SMALLINT)"))
    names, expected = [d[0] for d in found.description], found.fetchall()
    df = queries.type_roundtrip(spark, str(tmp_path))
    assert df.schema["small"].dataType.simpleString() == "smallint"
    rows = sorted(tuple(bytes(r[c]) if c == "raw" else r[c] for c in names) for r in df.collect())
    assert rows == sorted(expected)
    assert [r[names.index("small")] for r in rows] == [None, -32768, -1, 0, 32767, None, None, None]
    duck.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet') WHERE vec_id BETWEEN -32768 AND 32767")
    assert [r for r in rows if -32768 <= r[names.index("vec_id")] <= 32767] == sorted(duck.execute(sql).fetchall())
