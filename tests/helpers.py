"""Small inputs for the tests."""

import json
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from adstream.operators.events import PAYLOAD_CAMPAIGN, with_event_ts
from adstream.schemas import ENVELOPE

BASE = 1763595440000

AD_ROW = "campaign_id string, event_type string, event_time bigint"

GOLDEN = [
    ("1", "view", 1000),
    ("1", "click", 2000),
    ("1", "view", 9000),
    ("2", "view", 3000),
    ("3", "click", 4000),
    ("4", "purchase", 5000),
    (None, "view", 6000),
    (None, "click", 6500),
    ("1", "view", 10000),
    ("2", "view", 12500),
    ("2", "click", 13000),
]


def at(ms):
    """A time ms after BASE, as collect() of a UTC session returns it as text."""
    moment = datetime.fromtimestamp(BASE / 1000, timezone.utc) + timedelta(milliseconds=ms)
    return moment.strftime("%Y-%m-%d %H:%M:%S.") + f"{moment.microsecond // 1000:03d}"


def complete(df):
    """Ad events from (campaign, type, epoch ms)."""
    return with_event_ts(df).select(
        "*",
        F.col("event_ts").alias("kafka_ts"),
        F.col("campaign_id").cast("int").alias(PAYLOAD_CAMPAIGN),
        F.col("event_time").cast("double").alias("production_timestamp"),
    )


def ad_events(spark, rows):
    moved = [(c, kind, BASE + ms) for c, kind, ms in rows]
    return complete(spark.createDataFrame(moved, AD_ROW))


def envelopes(spark, rows):
    """Records from (key, text, ms)."""
    made = [
        (
            None if key is None else bytearray(key.encode()),
            None if text is None else bytearray(text.encode()),
            "ad-events",
            0,
            n,
            datetime.fromtimestamp((BASE + ms) / 1000, timezone.utc),
            0,
        )
        for n, (key, text, ms) in enumerate(rows)
    ]
    return spark.createDataFrame(made, ENVELOPE)


def payload(kind, ms, **more):
    return {"event_type": kind, "event_time": BASE + ms} | more


class FileFeed:
    """A folder that a file stream reads one file per batch, in the order added."""

    def __init__(self, folder):
        self.folder = str(folder)
        os.makedirs(self.folder, exist_ok=True)
        self.count = 0

    def add(self, *rows):
        """One file with rows of (campaign, type, ms)."""
        lines = [
            json.dumps({"campaign_id": c, "event_type": kind, "event_time": BASE + ms})
            for c, kind, ms in rows
        ]
        path = os.path.join(self.folder, f"part-{self.count:04d}.json")
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        # The source takes files by modification time.
        os.utime(path, (1_700_000_000 + self.count,) * 2)
        self.count += 1
        return self

    def stream(self, spark):
        return complete(
            spark.readStream.schema(AD_ROW).option("maxFilesPerTrigger", 1).json(self.folder)
        )


def texts(df, *columns):
    """Rows with all values as text, sorted."""
    picked = df.select(*[F.col(c).cast("string") for c in columns])
    return sorted((tuple(r) for r in picked.collect()), key=str)


