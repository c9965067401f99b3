"""Times in their many spellings, by the quick way and by parts."""

from datetime import UTC, datetime, timedelta, timezone

from pyspark.sql import functions as F

from quarryline.functions import cleaning as c

NOT = ["", "x", "2024", "2024-01-05", "2024-1-5T1:2:3", "2024-02-30T00:00:00Z", "2024-01-05T25:00:00Z", "2024-01-05T12:60:00", "epoch", "now", "2024-01-05T12:30:00 UTC", "2024-01-05T12:30:00[UTC]", "20240105", "2024-01-05T12:30:00+5", "12:30:00", None, "2024-01-05T1230", "20240105T12:30"]


def spellings():
    at = datetime(2024, 1, 5, 12, 30, 15, 123456, UTC)
    for hours in (0, 5.5, -8):
        zone = timezone(timedelta(hours=hours))
        t = at.astimezone(zone)
        sign, h, m = "-" if hours < 0 else "+", int(abs(hours)), int(abs(hours) % 1 * 60)
        zones = [f"{sign}{h:02d}:{m:02d}", f"{sign}{h:02d}{m:02d}"] + ([f"{sign}{h:02d}"] if not m else []) + (["Z", "z", ""] if not hours else [])
        for z in zones:
            for sep in "T", "t", " ":
                for frac, micros in (("", 0), (".5", 500_000), (",25", 250_000), (".123456", 123_456), (".123456789", 123_456)):
                    yield f"{t:%Y-%m-%d}{sep}{t:%H:%M:%S}{frac}{z}", (at.replace(microsecond=0), micros)
                yield f"{t:%Y-%m-%d}{sep}{t:%H:%M}{z}", (at.replace(second=0, microsecond=0), 0)
            if ":" not in z:
                yield f"{t:%Y%m%dT%H%M%S}{z}", (at.replace(microsecond=0), 0)
                yield f"  {t:%Y%m%dT%H%M%S}.75{z}\n", (at.replace(microsecond=0), 750_000)
                yield f"{t:%Y%m%dT%H%M}{z}", (at.replace(second=0, microsecond=0), 0)


def test_all_spellings(spark):
    rows = [(text, round(t.timestamp()) * 1_000_000 + micros) for text, (t, micros) in spellings()] + [(t, None) for t in NOT] + [("1969-12-31T23:59:59.5Z", -500_000), ("2024-02-29T23:59:59Z", 1709251199 * 10**6)]
    df = spark.createDataFrame(rows, "t string, want long")
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = df.select("t", "want", c.epoch_micros("t").alias("got"), F.when(c.strip("t").rlike(c._ISO), c._by_parts(c.strip("t"))).alias("parts")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [r for r in got if r.got != r.want] == []
        assert [r for r in got if r.parts != r.want] == []
    assert len(rows) > 150
