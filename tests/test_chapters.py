from pyspark.sql import functions as F

from talklake.functions import chapters

L = F.lit


def marks(rows):
    return [(r["timestamp"], r["title"], r["start_seconds"]) for r in rows]


def test_markers_in_text(one):
    found = one(chapters.from_text(L("About pods\n0:00 Start\n1:30 Pods and nodes\n5:00 Design of it\n8:00 End\n")))
    assert marks(found) == [
        ("0:00", "Start", 0.0),
        ("1:30", "Pods and nodes", 90.0),
        ("5:00", "Design of it", 300.0),
        ("8:00", "End", 480.0),
    ]


def test_hours_lines_and_odd_numbers(one):
    text = "Check\n0:00 Intro\n1:30 What is K8s\n01:05:30 Deep\n2:00\nNext line\n 3:00 indented\n99:99 odd "
    assert marks(one(chapters.from_text(L(text)))) == [
        ("0:00", "Intro", 0.0),
        ("1:30", "What is K8s", 90.0),
        ("1:05:30", "Deep", 3930.0),
        ("2:00", "Next line", 120.0),
        ("99:99", "odd", 6039.0),
    ]


def test_no_markers(one):
    assert one(chapters.from_text(L("at 5 we meet, 1:2 no"))) == []
    assert one(chapters.from_text(F.lit(None).cast("string"))) == []


def native(*rows):
    return F.array(
        *[
            F.struct(
                L(s).cast("double").alias("start_time"),
                L(None).cast("double").alias("end_time"),
                L(t).cast("string").alias("title"),
            )
            for s, t in rows
        ]
    )


def test_native_list(one):
    found = one(chapters.from_native(native((0, "Intro"), (90, None), (None, "x"), (3725.9, "late"))))
    assert marks(found) == [("0:00", "Intro", 0.0), ("1:30", "Untitled", 90.0), ("0:00", "x", 0.0), ("1:02:05", "late", 3725.9)]


def test_pick(one):
    empty = F.array().cast("array<struct<start_time:double,end_time:double,title:string>>")
    assert marks(one(chapters.pick(native((5, "a")), L("0:00 b")))) == [("0:05", "a", 5.0)]
    assert marks(one(chapters.pick(empty, L("0:00 b")))) == [("0:00", "b", 0.0)]
    assert one(chapters.pick(empty, L(""))) == []
