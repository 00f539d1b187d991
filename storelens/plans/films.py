"""Film popularity analyses (rental counts, categories, actors, attributes).

Rentals are the only large fact.  They are reduced to one row per
inventory copy (or per copy and staff member) before any join, and the
inventory-film-category chain is joined first as a dimension, so the
rental table is shuffled once, on its own key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.numeric import exact_mean, half_up_ratio
from storelens.operators.segments import score_rules, split_at, step_ladder
from storelens.operators.summaries import min_mean_max

# Rental-count bucket floors, checked top-down with ">".
RENTAL_BUCKETS = [(24, 24), (20, 20), (16, 16), (12, 12), (8, 8), (4, 4)]
# Floors of the actor-popularity bands (mean film count of a film's actors).
POPULARITY_FLOORS = (25, 27, 29, 31)
BAND_NONE = "F = 0"


def popularity_bands(d: int, c: int, b: int, a: int) -> list[tuple[int, str]]:
    """(floor, label), checked top-down with ">=": "A > 31", "B = 29-30", ... for 25, 27, 29, 31."""
    return [(a, f"A > {a}"), (b, f"B = {b}-{a - 1}"), (c, f"C = {c}-{b - 1}"), (d, f"D = {d}-{c - 1}")]


# ---------------------------------------------------------------- views


def rentals_per_film(films: DataFrame, inventory: DataFrame, rentals: DataFrame | None = None) -> DataFrame:
    """film_id, rental_count; films never rented (or never stocked) get 0.

    Rentals are counted per inventory copy first, then per film; film ids
    are grouped so repeated film rows count as often as the source join
    would count them.  Without ``rentals`` the inventory carries its own
    ``rental_count`` per copy, and no rental is read or joined.
    """
    copies = inventory.withColumnRenamed("rental_count", "n")
    if rentals is not None:
        per_copy = rentals.groupBy("inventory_id").agg(F.count("rental_id").alias("n"))
        copies = inventory.select("inventory_id", "film_id").join(per_copy, "inventory_id", "left")
    per_film = copies.groupBy("film_id").agg(F.sum("n").alias("n"))
    f = films.groupBy("film_id").agg(F.count(F.lit(1)).alias("k"))
    return f.join(per_film, "film_id", "left").select(
        "film_id", (F.coalesce(F.col("n"), F.lit(0)) * F.col("k")).cast("bigint")
        .alias("rental_count"))


def film_rental_summary(films, inventory, rentals) -> DataFrame:
    """Min / rounded mean / max rentals per film, zero-rental films included."""
    return min_mean_max(rentals_per_film(films, inventory, rentals), "rental_count",
                        ("min_rentals", "avg_rentals", "max_rentals"), 0)


def film_rental_grouped(films, inventory, rentals) -> DataFrame:
    """rentals_per_film + rental_count_group (floor of the 4-wide bucket;
    exactly 24 falls in bucket 20)."""
    fr = rentals_per_film(films, inventory, rentals)
    return fr.withColumn("rental_count_group",
                         step_ladder("rental_count", RENTAL_BUCKETS, 0).cast("int"))


def film_count_by_rental_group(films, inventory, rentals) -> DataFrame:
    """Films per rental-count bucket."""
    g = film_rental_grouped(films, inventory, rentals)
    return (g.groupBy("rental_count_group").agg(F.count(F.lit(1)).alias("count_films"))
            .orderBy("rental_count_group").select("count_films", "rental_count_group"))


def film_category_view(films: DataFrame, film_category: DataFrame,
                       category: DataFrame) -> DataFrame:
    """film_id, category (name); films without a category drop out."""
    return (films.select("film_id").join(film_category, "film_id")
            .join(category, "category_id").select("film_id", F.col("name").alias("category")))


def category_popularity(films, inventory, rentals, film_category, category) -> DataFrame:
    """Films and mean rentals per category, most rented first."""
    cn = film_category_view(films, film_category, category)
    fr = film_rental_grouped(films, inventory, rentals)
    return (cn.join(fr, "film_id").groupBy("category").agg(
        F.count("film_id").alias("film_count"),
        exact_mean(F.sum("rental_count"), F.count("rental_count"), 1).alias("avg_rental_count"))
        .orderBy(F.col("avg_rental_count").desc_nulls_last(), "category"))


def actor_film_count(film_actor: DataFrame) -> DataFrame:
    """actor_id, film_count."""
    return film_actor.groupBy("actor_id").agg(F.count(F.lit(1)).alias("film_count"))


def avg_actor_popularity(film_actor: DataFrame) -> DataFrame:
    """film_id, avg_actor_film_count: rounded mean film count of its actors.

    Actor counts are an aggregate (one row per actor) joined back on the
    actor; a prolific actor is one row on that side, and AQE splits a skewed
    actor partition on the film_actor side.
    """
    afc = actor_film_count(film_actor)
    return (film_actor.join(afc, "actor_id").groupBy("film_id").agg(
        exact_mean(F.sum("film_count"), F.count("film_count"), 0).alias("avg_actor_film_count")))


def _band(avg, floors) -> F.Column:
    rules = [(avg >= lo, label) for lo, label in popularity_bands(*floors)]
    return score_rules(rules + [(avg < floors[0], f"E < {floors[0]}")], BAND_NONE)


def rentals_by_actor_popularity_band(films, inventory, rentals, film_actor,
                                     floors=POPULARITY_FLOORS) -> DataFrame:
    """Films, rentals and mean actor popularity per popularity band; films
    without actors form band 'F = 0'."""
    fr = film_rental_grouped(films, inventory, rentals)
    ap = avg_actor_popularity(film_actor)
    j = fr.join(ap, "film_id", "left")
    avg = F.col("avg_actor_film_count")
    return (j.groupBy(_band(avg, floors).alias("avg_actor_film_count_group")).agg(
        F.count("film_id").alias("film_count_group"),
        F.sum("rental_count").cast("bigint").alias("rental_counts_group"),
        exact_mean(F.sum(avg.cast("bigint")), F.count(avg), 0).alias("avg_actor_group"))
        .orderBy("avg_actor_film_count_group")
        .select("film_count_group", "rental_counts_group", "avg_actor_group",
                "avg_actor_film_count_group"))


def likelihood_score(avg, cat, favoured="Sci-Fi", excluded="Foreign",
                     high: float = 28, low: float = 25):
    """Rental-likelihood score 1-5 from actor popularity and category.

    ``favoured`` / ``excluded`` are one name (the source's predicate as MySQL
    evaluates it) or a list of names (the predicate the source meant:
    ``IN`` / ``NOT IN``).
    """
    fav = cat.isin(*favoured) if isinstance(favoured, (list, tuple)) else cat == favoured
    exc = ~cat.isin(*excluded) if isinstance(excluded, (list, tuple)) else cat != excluded
    return score_rules([((avg > high) & fav, 5),
                        ((avg > low) & fav, 4),
                        ((avg > high) & exc, 3),
                        ((avg > low) & exc, 2)], 1)


def rental_likelihood_by_category(films, inventory, rentals, film_actor, film_category,
                                  category, favoured="Sci-Fi", excluded="Foreign",
                                  high: float = 28, low: float = 25,
                                  key_on_rental_side: bool = False) -> DataFrame:
    """Per category: rentals and the mean rental-likelihood score (1-5) of its
    films, from actor popularity and category.

    Scoring follows the source's predicates as MySQL evaluates them:
    ``c = 'X' || 'Y' || 'Z'`` is ``c = 'X'`` there (``||`` is OR and a word
    is false), so only the first favoured / excluded name counts.

    The category side keys on the actor side's film id, as the source's
    second RIGHT JOIN does, so films without actors keep their category but
    lose their rental count; ``key_on_rental_side=True`` keys on the rental
    side instead.
    """
    ap = avg_actor_popularity(film_actor).withColumnRenamed("film_id", "ap_film_id")
    fr = film_rental_grouped(films, inventory, rentals).withColumnRenamed("film_id", "fr_film_id")
    fc = film_category_view(films, film_category, category)
    # ap RIGHT JOIN fr  ==  fr LEFT JOIN ap
    left = fr.join(ap, F.col("ap_film_id") == F.col("fr_film_id"), "left")
    key = "fr_film_id" if key_on_rental_side else "ap_film_id"
    # (...) RIGHT JOIN fc  ==  fc LEFT JOIN (...)
    lg = fc.join(left, fc["film_id"] == left[key], "left")
    score = likelihood_score(F.col("avg_actor_film_count"), F.col("category"),
                             favoured, excluded, high, low)
    return (lg.groupBy("category").agg(
        F.sum("rental_count").cast("bigint").alias("rental_count"),
        exact_mean(F.sum(score), F.count(score), 2).alias("avg_likeli_group"))
        .orderBy(F.col("avg_likeli_group").desc_nulls_last(), "category"))


# ------------------------------------------------ rental x film attributes


def inventory_dimension(inventory, films, film_category, category) -> DataFrame:
    """Copy -> film attributes and category name.  The film join is written
    LEFT in the source but the category joins key on the film side, which
    makes it inner; all joins here are inner."""
    return (inventory.join(films, "film_id").join(film_category, "film_id")
            .join(category, "category_id")
            .select("inventory_id", "film_id", "rental_rate", "length", "replacement_cost",
                    "rating", "name"))


def rental_calculation_view(rentals, inventory, films, film_category, category) -> DataFrame:
    """Every rental with its film's attributes and category (row level)."""
    dim = inventory_dimension(inventory, films, film_category, category)
    return rentals.join(dim, "inventory_id").select(
        "rental_id", "staff_id", "film_id", "rental_rate", "length", "replacement_cost",
        "rating", "name")


def _rentals_with_dim(rentals, inventory, films, film_category, category,
                      keys=("inventory_id",)) -> DataFrame:
    """Rentals counted per copy (and extra keys) before meeting the
    dimension: the aggregate of rental_calculation_view without its rows."""
    per = rentals.groupBy(*keys).agg(F.count("rental_id").alias("n"))
    dim = inventory_dimension(inventory, films, film_category, category)
    return per.join(dim, "inventory_id")


def rating_ratio(rentals, inventory, films, film_category, category) -> DataFrame:
    """Per rating: rentals, distinct rented films, films / rentals (3 digits)."""
    j = _rentals_with_dim(rentals, inventory, films, film_category, category)
    g = j.groupBy("rating").agg(F.sum("n").cast("bigint").alias("rental"),
                                F.countDistinct("film_id").alias("film"))
    return (g.select("rental", "film", "rating",
                     half_up_ratio("film", "rental", 3).alias("coeff"))
            .orderBy(F.col("rental").desc(), "rating"))


def cost_group_rentals(rentals, inventory, films, film_category, category,
                       threshold: float = 20.1) -> DataFrame:
    """Rentals of films above (1) / below (2) a replacement cost; 0 = equal or unknown."""
    j = _rentals_with_dim(rentals, inventory, films, film_category, category)
    return (j.groupBy(split_at("replacement_cost", threshold).alias("cost_group"))
            .agg(F.sum("n").cast("bigint").alias("rental")).orderBy("cost_group"))


def length_group_rentals(rentals, inventory, films, film_category, category,
                         threshold: float = 115.5) -> DataFrame:
    """Rentals of films longer (1) / shorter (2) than a length; 0 = equal or unknown."""
    j = _rentals_with_dim(rentals, inventory, films, film_category, category)
    return (j.groupBy(split_at("length", threshold).alias("length_group"))
            .agg(F.sum("n").cast("bigint").alias("rental")))


def rentals_per_staff(rentals, inventory, films, film_category, category) -> DataFrame:
    """Rentals handled per staff member."""
    j = _rentals_with_dim(rentals, inventory, films, film_category, category,
                          keys=("inventory_id", "staff_id"))
    return (j.groupBy("staff_id").agg(F.sum("n").cast("bigint").alias("rental"))
            .select("rental", "staff_id"))
