"""Film analyses: ladders (edges), scoring (T10), chained right joins (T11),
and invariants between the views."""

from pyspark.sql import functions as F

from storelens.operators.segments import split_at, step_ladder
from storelens.plans import films as fm
from storelens.plans.registry import QUERIES

from conftest import SF_SMALL, rows


def test_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 4, 5, 8, 24, 25)], "c long")
    got = [r[0] for r in df.select(step_ladder("c", fm.RENTAL_BUCKETS, 0)).collect()]
    assert got == [0, 0, 4, 4, 20, 24]


def test_split_edges(spark):
    df = spark.createDataFrame([(20.0,), (20.1,), (20.2,), (None,)], "x double")
    assert [r[0] for r in df.select(split_at("x", 20.1)).collect()] == [2, 0, 1, 0]


def test_likelihood_score_rules(spark):
    df = spark.createDataFrame([(30.0, "Sci-Fi"), (27.0, "Sci-Fi"), (30.0, "Animation"),
                                (27.0, "Travel"), (30.0, "Foreign"), (None, "Sci-Fi")],
                               "a double, c string")
    got = [r[0] for r in df.select(fm.likelihood_score(F.col("a"), F.col("c"))).collect()]
    assert got == [5, 4, 3, 2, 1, 1]


def _roles(spark):
    films = spark.createDataFrame([(1, 1.0, 10, 5.0, "G"), (2, 1.0, 20, 25.0, "PG"),
                                   (3, 1.0, 30, 20.1, "G")],
                                  "film_id long, rental_rate double, length int, "
                                  "replacement_cost double, rating string")
    inventory = spark.createDataFrame([(10, 1), (20, 2)], "inventory_id long, film_id long")
    rentals = spark.createDataFrame([(100, 10, 1), (101, 10, 2)],
                                    "rental_id long, inventory_id long, staff_id int")
    actor = spark.createDataFrame([(7, 1)], "actor_id long, film_id long")
    fc = spark.createDataFrame([(1, "A"), (2, "B")], "film_id long, category_id string")
    cat = spark.createDataFrame([("A", "A"), ("B", "B")], "category_id string, name string")
    return films, inventory, rentals, actor, fc, cat


def test_film_roles(spark):
    # mf_film_roles: film 2 has no actor and no rental, film 3 no copy and no category
    films, inv, rent, actor, fc, cat = _roles(spark)
    assert rows(fm.rentals_per_film(films, inv, rent)) == [(1, 2), (2, 0), (3, 0)]
    assert rows(fm.film_category_view(films, fc, cat)) == [(1, "A"), (2, "B")]
    bands = rows(fm.rentals_by_actor_popularity_band(films, inv, rent, actor))
    assert bands == [(1, 2, 1.0, "E < 25"), (2, 0, None, "F = 0")]
    # T11: keyed on the actor side, film 2 keeps its category but loses its count
    lik = rows(fm.rental_likelihood_by_category(films, inv, rent, actor, fc, cat))
    assert lik == [("A", 2, 1.0), ("B", None, 1.0)]
    lik2 = rows(fm.rental_likelihood_by_category(films, inv, rent, actor, fc, cat,
                                                 key_on_rental_side=True))
    assert lik2 == [("A", 2, 1.0), ("B", 0, 1.0)]


def test_rental_calculation_aggregates(spark):
    films, inv, rent, actor, fc, cat = _roles(spark)
    view = fm.rental_calculation_view(rent, inv, films, fc, cat)
    assert view.count() == 2
    assert rows(fm.cost_group_rentals(rent, inv, films, fc, cat, threshold=5.0)) == [(0, 2)]
    assert rows(fm.rentals_per_staff(rent, inv, films, fc, cat)) == [(1, 1), (1, 2)]
    assert rows(fm.rating_ratio(rent, inv, films, fc, cat)) == [(2, 1, "G", 0.5)]


def test_view_invariants(spark):
    q = lambda k: QUERIES[k](spark, SF_SMALL)
    films = q("film_rental_view").count()
    assert q("film_count_by_rental_group").agg(F.sum("count_films")).first()[0] == films
    n = q("rental_calculation_view").count()
    for k in ("cost_group_rentals", "length_group_rentals", "rentals_per_staff"):
        assert q(k).agg(F.sum("rental")).first()[0] == n
    assert q("rating_ratio").agg(F.sum("rental")).first()[0] == n


def test_intended_category_lists(spark):
    df = spark.createDataFrame([(30.0, "Animation"), (30.0, "Travel")], "a double, c string")
    literal = fm.likelihood_score(F.col("a"), F.col("c"))
    intended = fm.likelihood_score(F.col("a"), F.col("c"), favoured=["Sci-Fi", "Animation"],
                                   excluded=["Foreign", "Travel"])
    assert [r[0] for r in df.select(literal).collect()] == [3, 3]
    assert [r[0] for r in df.select(intended).collect()] == [5, 1]
