"""Tiny tables with known answers (FIXTURES.md part A).

The rows of the tables below and the answers expected of them are fixed values.
"""

import os

from pyspark.sql import functions as F

from olapkit.operators.modeling import (add_surrogate_key, denormalize, extract_dimension, lookup,
                                        materialize_for_query, split_entity, to_1nf, upsert)
from olapkit.sources.readers import rows

from .conftest import plan_text, rows_of

MUSIC_STORE = "transaction_id int, customer_name string, cashier_name string, year int, albums_purchased array<string>"
MUSIC_ROWS = [
    (1, "Amanda", "Sam", 2000, ["Rubber Soul", "Let it Be"]),
    (2, "Toby", "Sam", 2000, ["My Generation"]),
    (3, "Max", "Bob", 2018, ["Meet the Beatles", "Help!"]),
]


def test_normal_forms_and_rejoin(spark):
    store = rows(spark, MUSIC_STORE, MUSIC_ROWS)
    nf1 = to_1nf(store, "albums_purchased", "album_name")
    assert nf1.count() == 5
    parent, child = split_entity(nf1, ["transaction_id"], ["customer_name", "cashier_name", "year"])
    assert parent.count() == 3 and child.count() == 5
    by_name, _ = extract_dimension(parent, "cashier_name", "cashier_id", "employee_name")
    assert rows_of(by_name, ["cashier_id", "employee_name"]) == [(1, "Bob"), (2, "Sam")]
    # ids in order of first appearance, as inserted in the exercise: Sam 1, Bob 2
    employees, transactions = extract_dimension(parent, "cashier_name", "cashier_id", "employee_name",
                                                first_seen_by="transaction_id")
    assert rows_of(employees, ["cashier_id", "employee_name"]) == [(1, "Sam"), (2, "Bob")]
    back = (transactions.join(employees, "cashier_id").join(child, "transaction_id")
            .select("transaction_id", "customer_name", F.col("employee_name").alias("cashier_name"),
                    "year", "album_name"))
    assert rows_of(back) == rows_of(nf1.select(*back.columns))


def test_denormalize_spend_and_cashier_totals(spark):
    tx = rows(spark, "transaction_id int, customer_name string, year int, cashier_id int",
              [(1, "Amanda", 2000, 1), (2, "Toby", 2000, 1), (3, "Max", 2018, 2)])
    emp = rows(spark, "employee_id int, employee_name string", [(1, "Sam"), (2, "Bob")])
    sales = rows(spark, "transaction_id int, amount_spent int", [(1, 40), (2, 19), (3, 45)])
    spend = denormalize(tx, [(sales, "transaction_id", "inner")])
    assert rows_of(spend, ["transaction_id", "customer_name", "amount_spent"]) == [
        (1, "Amanda", 40), (2, "Toby", 19), (3, "Max", 45)]
    emp = emp.withColumnRenamed("employee_id", "cashier_id")
    cashier = (denormalize(spend, [(emp, "cashier_id", "inner")])
               .groupBy("employee_name").agg(F.sum("amount_spent").alias("total")))
    assert rows_of(cashier) == [("Bob", 45), ("Sam", 59)]


def test_small_star(spark):
    ct = rows(spark, "customer_id int, store_id int, spent double", [(1, 1, 20.50), (2, 1, 35.21)])
    cu = rows(spark, "customer_id int, customer_name string, rewards boolean", [(1, "Amanda", True), (2, "Toby", False)])
    st = rows(spark, "store_id int, state string", [(1, "CA"), (2, "WA")])
    it = rows(spark, "customer_id int, item_id int, item_name string", [(1, 1, "Rubber Soul"), (2, 3, "Let it Be")])
    q = (ct.join(cu, "customer_id").join(st, "store_id").join(it, "customer_id")
         .filter(F.col("spent") > 30).select("customer_name", "store_id", "state", "item_name", "rewards"))
    assert rows_of(q) == [("Toby", 1, "CA", "Let it Be", False)]
    assert rows_of(ct.filter("customer_id = 2").select("customer_id", "spent")) == [(2, 35.21)]


LIBRARY = [
    (1970, "The Beatles", "Let it Be", "Liverpool"),
    (1965, "The Beatles", "Rubber Soul", "Oxford"),
    (1965, "The Who", "My Generation", "London"),
    (1966, "The Monkees", "The Monkees", "Los Angeles"),
    (1970, "The Carpenters", "Close To You", "San Diego"),
]
LIB_SCHEMA = "year int, artist_name string, album_name string, city string"


def test_one_table_per_query(spark, tmp_dir):
    lib = rows(spark, LIB_SCHEMA, LIBRARY)
    by_year = materialize_for_query(lib, f"{tmp_dir}/y", ["year"], ["artist_name", "album_name"])
    q = lookup(by_year, year=1970)
    assert "PartitionFilters: [isnotnull(year" in plan_text(q)
    assert rows_of(q, ["album_name"]) == [("Close To You",), ("Let it Be",)]
    by_artist = materialize_for_query(lib, f"{tmp_dir}/a", ["artist_name"], ["year"])
    assert rows_of(lookup(by_artist, artist_name="The Beatles"), ["album_name"]) == [("Let it Be",), ("Rubber Soul",)]
    by_album = materialize_for_query(lib, f"{tmp_dir}/b", ["album_name"], [], directories=False)
    assert lookup(by_album, album_name="Close To You").count() == 1
    city = lookup(by_year, year=1965, artist_name="The Beatles", album_name="Rubber Soul").select("city")
    assert rows_of(city) == [("Oxford",)]


def test_upsert_by_key_loses_rows_when_key_not_unique(spark):
    lib = rows(spark, LIB_SCHEMA, LIBRARY)
    assert upsert(lib, ["year"], ["album_name"]).count() == 3
    assert upsert(lib, ["year", "album_name"], ["city"]).count() == 5
    once = upsert(lib, ["year"], ["album_name"])
    assert rows_of(upsert(once, ["year"], ["album_name"])) == rows_of(once)   # idempotent
    # last write wins: the greatest album name per year
    assert rows_of(once, ["year", "album_name"]) == [(1965, "Rubber Soul"), (1966, "The Monkees"),
                                                     (1970, "Let it Be")]


def test_surrogate_key_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v"))
    out = add_surrogate_key(df, ["k"], "sk", num_partitions=7)
    got = rows_of(out, ["k", "sk"])
    assert got == [(k, k + 1) for k in range(5000)]


def test_per_query_layout_splits_a_hot_key(spark, tmp_dir):
    # one year holds almost every row: the writer tasks still share it
    df = spark.range(0, 4000).select(F.when(F.col("id") < 3900, 1970).otherwise(1965).alias("year"),
                                     F.col("id").cast("string").alias("album_name"))
    out = materialize_for_query(df, f"{tmp_dir}/hot", ["year"], [], num_partitions=8)
    files = [f for f in os.listdir(f"{tmp_dir}/hot/year=1970") if f.endswith(".parquet")]
    assert len(files) >= 4
    assert out.filter("year = 1970").count() == 3900


def test_merge_upsert_later_write_wins(spark):
    from olapkit.operators.modeling import merge_upsert

    lib = rows(spark, LIB_SCHEMA, LIBRARY)
    change = rows(spark, LIB_SCHEMA, [(1965, "The Beatles", "Rubber Soul", "Abbey Road"),     # overwrite
                                      (2001, "New Artist", "New Album", "Leeds")])             # insert
    out = merge_upsert(lib, change, ["year", "artist_name", "album_name"])
    got = rows_of(out)
    assert len(got) == 6
    assert (1965, "The Beatles", "Rubber Soul", "Abbey Road") in got
    assert (1965, "The Beatles", "Rubber Soul", "Oxford") not in got
    # applying the same batch twice changes nothing
    assert rows_of(merge_upsert(out, change, ["year", "artist_name", "album_name"])) == got
