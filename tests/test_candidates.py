from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from talklake.operators import candidates as cand, enrich, registry
from talklake.schemas import CHANNELS, DETAILS, LISTING
from talklake.sources.landing import conform, read

AS_OF = datetime(2026, 3, 1, 6, 30)


def day(age):
    return (AS_OF - timedelta(days=age)).strftime("%Y%m%d")


@pytest.fixture(scope="module")
def channels(spark):
    return spark.createDataFrame(
        [
            (0, "@a", "A", None, None, 2, ["t1", "t2"]),
            (1, "UCb", "B", False, 30, 5, None),
            (2, "plain", "C", True, 10, None, None),
        ],
        CHANNELS,
    )


@pytest.fixture(scope="module")
def listing(spark):
    def entry(channel, position, id_, date, **more):
        row = dict(channel_id=channel, channel_name=None, position=position, id=id_, title=None, url=None, duration=None, upload_date=date)
        return tuple({**row, **more}[f.name] for f in LISTING)

    return spark.createDataFrame(
        [
            entry("@a", 1, None, day(1)),
            entry("@a", 2, "a2", day(1), title="Two", duration=61, url="u2", channel_name="Chan A"),
            entry("@a", 3, "a3", day(31)),
            entry("@a", 4, "a4", None),
            entry("@a", 5, "a5", day(0)),
            entry("UCb", 1, "b1", day(0)),
            entry("plain", 1, "c1", "not a date"),
            entry("plain", 2, "c2", day(9)),
            entry("plain", 3, "", day(0)),
            entry("plain", 4, "c4", day(10)),
            entry("plain", 5, "a2", day(2)),
            entry("gone", 1, "x1", day(0)),
        ],
        LISTING,
    )


def test_recent_videos(listing, channels):
    rows = cand.recent_videos(listing, channels, AS_OF).orderBy("ord", "position").collect()
    # a5 lies beyond twice the limit; c4's midnight is older than ten days before half past six.
    assert [(r["channel_id"], r["video_id"]) for r in rows] == [
        ("@a", "a2"), ("@a", "a4"), ("plain", "c1"), ("plain", "c2"), ("plain", "a2"),
    ]
    two, four = rows[0], rows[1]
    assert (two["title"], two["channel"], two["url"], two["duration_seconds"]) == ("Two", "Chan A", "u2", 61)
    assert (four["title"], four["channel"], four["duration_seconds"]) == ("Unknown", "@a", 0)
    assert four["url"] == "https://www.youtube.com/watch?v=a4"
    assert four["published"] == AS_OF and two["published"] == datetime(2026, 2, 28)
    assert two["metadata_tags"] == ["t1", "t2"] and rows[2]["metadata_tags"] == []
    assert two["description"] == "" and two["chapters"] == []


def test_order_of_rows_does_not_matter(listing, channels):
    rows = lambda df: sorted(cand.recent_videos(df, channels, AS_OF).drop("chapters").collect(), key=str)
    assert rows(listing) == rows(listing.orderBy(F.desc("id")).repartition(7))


def test_age_limit_is_inclusive(spark):
    rows = spark.createDataFrame([(AS_OF - timedelta(days=3),), (AS_OF - timedelta(days=3, seconds=1),)], "p timestamp_ntz")
    assert rows.where(cand.young_enough(F.col("p"), AS_OF, F.lit(3))).count() == 1


def test_positions_are_cut_before_the_join(listing, channels, plan):
    text = plan(cand.recent_videos(listing, channels, AS_OF))
    assert "position" in text and "Subquery" in text


def test_the_position_bound_reaches_the_scan(spark, listing, channels, tmp_path):
    """On a landed table the largest look-ahead is a filter of the scan, and a parameter lifts it."""
    path = str(tmp_path / "listing")
    listing.write.parquet(path)
    landed = read(spark, "listing", path)
    found = cand.recent_videos(landed, channels, AS_OF)
    found.collect()
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "scalar-subquery" in scan and "LessThanOrEqual(position" in scan or "position" in scan.split("DataFilters")[1]
    assert cand.recent_videos(landed, channels, AS_OF, lookahead=None).count() >= found.count()


def test_skip_stored_and_repeats(spark, listing, channels):
    recent = cand.recent_videos(listing, channels, AS_OF)
    store = cand.with_point(spark.createDataFrame([("a4",), ("a4",), ("zz",)], "video_id string"), 8)
    todo = cand.first_in_run(cand.unprocessed(cand.with_point(recent, 8), store))
    rows = todo.orderBy("ord", "position").collect()
    assert [(r["ord"], r["video_id"]) for r in rows] == [(0, "a2"), (2, "c1"), (2, "c2")]
    assert [r["line"] for r in cand.dry_run(todo).orderBy("ord", "position").collect()][0] == "[DRY RUN] Would process: Two (a2)"
    counts = {r["channel_id"]: r["video_count"] for r in cand.recent_counts(recent).collect()}
    assert counts == {"@a": 2, "plain": 3}


def test_first_in_run_is_cut_before_the_shuffle(listing, channels, plan):
    text = plan(cand.first_in_run(cand.recent_videos(listing, channels, AS_OF)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_details_replace_all_or_nothing(spark, listing, channels):
    details = spark.createDataFrame(
        [
            ("a2", None, "Det", day(5), None, None, None, None),
            ("c2", "T", None, "bad", "w", 7, "0:00 x", [(0.0, 1.0, "n")]),
            ("other", "T", None, None, None, 7, None, None),
        ],
        DETAILS,
    )
    todo = cand.first_in_run(cand.recent_videos(listing, channels, AS_OF))
    rows = {r["video_id"]: r for r in enrich.with_details(todo, details, AS_OF).collect()}
    assert set(rows) == {"a2", "a4", "c1", "c2"}
    # The listing's title, url and duration are not mixed into a detail record.
    assert (rows["a2"]["title"], rows["a2"]["channel"], rows["a2"]["duration_seconds"]) == ("Unknown", "Det", 0)
    assert rows["a2"]["url"].endswith("watch?v=a2") and rows["a2"]["published"] == datetime(2026, 2, 24)
    assert rows["c2"]["published"] == AS_OF and rows["c2"]["channel"] == "Unknown"
    assert rows["c2"]["chapters"][0]["title"] == "n"
    assert rows["a4"]["channel"] == "@a"
    assert rows["a2"]["metadata_tags"] == ["t1", "t2"]


def test_text_and_tags(spark, channels):
    videos = spark.createDataFrame([("1", "@a"), ("2", "UCb"), ("3", "@a")], "video_id string, channel_id string")
    texts = spark.createDataFrame([("1", "x"), ("2", ""), ("9", "y")], "video_id string, transcript string")
    assert [r["video_id"] for r in enrich.with_text(videos, texts).collect()] == ["1"]
    tags = {r["video_id"]: r["metadata_tags"] for r in enrich.with_tags(videos, channels).collect()}
    assert tags == {"1": ["t1", "t2"], "2": [], "3": ["t1", "t2"]}


def test_registry(channels, one):
    rows = {r["channel_id"]: r for r in registry.with_defaults(channels).collect()}
    assert rows["@a"]["enabled"] is True and rows["@a"]["max_age_days"] == 30
    assert rows["UCb"]["enabled"] is False and rows["plain"]["max_videos_per_run"] == 5
    assert [r["channel_id"] for r in registry.enabled(channels).collect()] == ["@a", "plain"]
    lines = [r["line"] for r in registry.report(channels).orderBy("ord").collect()]
    assert lines == [
        "  Channels: 3 configured",
        "    - A (@a) [enabled]",
        "    - B (UCb) [disabled]",
        "    - C (plain) [enabled]",
    ]
    for handle, page in [("@a", "@a/videos"), ("UCb", "channel/UCb/videos"), ("plain", "plain/videos")]:
        assert one(registry.listing_url(F.lit(handle))) == f"https://www.youtube.com/{page}"


def test_registry_from_json(spark, tmp_path):
    path = tmp_path / "channels.json"
    path.write_text('{"ord": 0, "channel_id": "@a", "name": "A", "other": 1}\n{"ord": 1, "channel_id": "@b", "name": "B", "enabled": false, "metadata_tags": ["x"]}\n')
    rows = registry.with_defaults(read(spark, "channels", str(path), "json")).orderBy("ord").collect()
    assert [(r["enabled"], r["max_age_days"], r["max_videos_per_run"], r["metadata_tags"]) for r in rows] == [
        (True, 30, 5, []),
        (False, 30, 5, ["x"]),
    ]


def test_conform_fills_missing_columns(spark):
    row = conform(spark.createDataFrame([("v", "t", 3)], "video_id string, track_id string, seq long"), "segments").first()
    assert row["text"] is None and row["seq"] == 3
