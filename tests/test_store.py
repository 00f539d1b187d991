"""Plans on store-shaped tables: from a folder, from a catalog schema, and as named views."""

import pytest

from storelens.plans import commerce as cm
from storelens.plans import films as fm
from storelens.plans import items as it
from storelens.plans import loyalty as ly
from storelens.plans.registry import LIBRARY_QUERIES
from storelens.sources import commerce, rental
from storelens.sources.store import Store, register_views
from storelens.sources.tables import Tables

from conftest import SF_SMALL, rows

FILM = ("films", "inventory", "film_rentals", "film_category", "category", "film_actor")


def shop(t):
    return {"orders": commerce.orders(t), "customers": commerce.customers(t), "order_items": commerce.order_items(t),
            "order_payments": commerce.order_payments(t), "order_reviews": commerce.order_reviews(t)}


def test_shop_folder(spark, tmp_path):
    for name, df in shop(Tables(spark, SF_SMALL)).items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    store = Store(spark, root=str(tmp_path))
    for key, plan in (("top_cities_by_avg_payment", cm.top_cities_by_avg_payment),
                      ("canceled_handed_to_carrier_share", cm.canceled_handed_to_carrier_share),
                      ("review_vs_item_features", it.review_vs_item_features)):
        assert rows(store.run(plan)) == rows(LIBRARY_QUERIES[key](spark, SF_SMALL))
    assert store.run(it.item_order_number, limit=5).count() == 5
    with pytest.raises(ValueError):
        Store(spark)


def test_rental_catalog_and_views(spark):
    t = Tables(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS store_test")
    try:
        tables = {"rental": rental.film_rentals(t), "film": rental.films(t), "inventory": rental.inventory(t),
                  "film_category": rental.film_category(t), "category": rental.category(t),
                  "film_actor": rental.film_actor(t), "payment": rental.payments(t)}
        for name, df in tables.items():
            df.write.mode("overwrite").saveAsTable(f"store_test.{name}")
        store = Store(spark, schema="store_test")
        assert rows(store.run(fm.film_rental_summary)) == rows(LIBRARY_QUERIES["film_rental_summary"](spark, SF_SMALL))
        assert rows(store.run(ly.above_average_payers)) == rows(LIBRARY_QUERIES["above_average_payers"](spark, SF_SMALL))
        register_views(store, {"film_category_name": "names"})
        assert spark.table("names").count() == spark.table("film_rental").count()
        got = spark.sql("SELECT rental_count_group, COUNT(*) FROM film_rental_grouped GROUP BY 1 ORDER BY 1").collect()
        want = LIBRARY_QUERIES["film_count_by_rental_group"](spark, SF_SMALL).collect()
        assert [(r[1], r[0]) for r in got] == [tuple(r) for r in want]
        assert spark.table("rental_calculation").count() == t.lineitem.count()
    finally:
        spark.sql("DROP DATABASE IF EXISTS store_test CASCADE")


def test_statements_over_the_replaced_view(spark):
    """film_rental is created, then replaced under its name; later statements read the replaced form."""
    t = Tables(spark, SF_SMALL)
    tables = {"rental": rental.film_rentals(t), "film": rental.films(t), "inventory": rental.inventory(t),
              "film_category": rental.film_category(t), "category": rental.category(t)}

    class Given(Store):
        def __init__(self):
            self.spark = spark

        def table(self, name):
            return tables[name]

    fm.rentals_per_film(tables["film"], tables["inventory"], tables["rental"]).createOrReplaceTempView("film_rental")
    assert spark.table("film_rental").columns == ["film_id", "rental_count"]
    register_views(Given())
    assert spark.table("film_rental").columns == ["film_id", "rental_count", "rental_count_group"]
    got = spark.sql("SELECT rental_count_group AS g, COUNT(film_id) AS n FROM film_rental GROUP BY g ORDER BY g").collect()
    want = LIBRARY_QUERIES["film_count_by_rental_group"](spark, SF_SMALL).collect()
    assert [(r.n, r.g) for r in got] == [tuple(r) for r in want]
    means = spark.sql("SELECT category, AVG(rental_count) AS mean FROM film_rental JOIN film_category_name USING (film_id) "
                      "GROUP BY category").collect()
    popular = {r.category: r.avg_rental_count for r in LIBRARY_QUERIES["category_popularity"](spark, SF_SMALL).collect()}
    assert {r.category: round(r.mean, 1) for r in means}.keys() == popular.keys()
    assert all(abs(r.mean - popular[r.category]) <= 0.0501 for r in means)


@pytest.mark.parametrize("lacking", [0, 3, 6])
def test_every_file_must_have_every_column(spark, tmp_path, monkeypatch, lacking):
    from storelens.sources import tables
    monkeypatch.setattr(tables, "FILES_A_TASK", 2)
    path = tmp_path / "supplier.parquet"
    whole = spark.range(5).selectExpr("id as s_suppkey", "'n' as s_name", "cast(1 as int) as s_nationkey",
                                      "cast(0 as double) as s_acctbal")
    for i in range(7):
        part = whole.drop("s_nationkey", "s_name") if i == lacking else whole
        part.coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        file = next((tmp_path / f"part{i}").glob("*.parquet"))
        path.mkdir(exist_ok=True)
        (path / f"part-{i}.parquet").write_bytes(file.read_bytes())
    with pytest.raises(ValueError, match=f"part-{lacking}.parquet has no column s_name, s_nationkey"):
        Tables(spark, str(tmp_path)).read("supplier")
    (path / f"part-{lacking}.parquet").write_bytes((path / f"part-{(lacking + 1) % 7}.parquet").read_bytes())
    assert Tables(spark, str(tmp_path)).read("supplier").count() == 35
    assert tables.data_files(spark, str(tmp_path / "none.parquet")) == []


def test_copies_with_large_ids_stay_apart(spark):
    li = spark.createDataFrame([(1, 11, 1000005, 1, "F"), (2, 12, 5, 1, "O")],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_linestatus string")

    class T:
        lineitem = li

    films = spark.createDataFrame([(11,), (12,), (13,)], "film_id long")
    got = rows(fm.rentals_per_film(films, rental.inventory(T), rental.film_rentals(T)))
    assert got == [(11, 1), (12, 1), (13, 0)]
