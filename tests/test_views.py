import datetime as dt
from decimal import Decimal

from reelhouse.plans import catalog, gold, run


def same(a, b):
    key = lambda r: repr(tuple(r))
    return sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


def test_gold_views_match_builders(spark):
    catalog.ensure_layers(spark, ("silver_v", "gold_v"))
    ratings = spark.createDataFrame(
        [(dt.date(2024, 1, i % 28 + 1), f"F{i % 7}" if i % 5 else None, 1990 + i % 4 if i % 6 else None,
          f"u{i % 13}", Decimal(f"{i % 5}.5") if i % 9 else None) for i in range(80)],
        "list_date date, name string, year int, letterboxd_uri string, rating decimal(3,1)",
    )
    diary = spark.createDataFrame(
        [(f"F{i}", 2000, dt.date(2024, 1 + i % 12, 1 + i % 27) if i % 8 else None,
          Decimal("3.5"), i % 2 == 0, f"u{i}") for i in range(40)],
        "name string, year int, watched_date date, rating decimal(3,1), rewatch boolean, letterboxd_uri string",
    )
    watchlist = spark.createDataFrame(
        [(None, f"F{i}", 1990 + i % 5 if i % 4 else None, f"w{i}") for i in range(30)],
        "list_date date, name string, year int, letterboxd_uri string",
    )
    catalog.save_table(ratings, "silver_v", "silver_ratings")
    catalog.save_table(diary, "silver_v", "silver_diary")
    catalog.save_table(watchlist, "silver_v", "silver_watchlist")
    built = run.build_gold(spark, silver_layer="silver_v", gold_layer="gold_v", as_view=True)
    assert len(built) == 6
    for name, (src, builder) in gold.GOLD_BUILDERS.items():
        view = spark.table(f"gold_v.{name}")
        direct = builder(spark.table(f"silver_v.silver_{src}"))
        assert view.schema.simpleString() == direct.schema.simpleString(), name
        assert same(view, direct), name
