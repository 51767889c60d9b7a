from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kwpulse.schemas import KW  # noqa: E402
from kwpulse.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(master="local[*]", shuffle_partitions=8)
    # Tests are the one place that sets the shared folder (only when unset).
    if s.sparkContext.getCheckpointDir() is None and s.conf.get("spark.checkpoint.dir", None) is None:
        d = str(tmp_path_factory.mktemp("ckpt"))
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def kw_rows(spark, rows):
    """Fact rows from dicts; missing fields default (keyword k, modality caption, ...)."""
    base = dict(video_id="v", keyword="k", modality="caption", confidence=1.0,
                detected_at=ts("2024-01-30 12:00:00"), posted_at=None, region="US",
                category="music", stats='{"diggCount":1,"commentCount":1,"shareCount":1,'
                                        '"collectCount":1,"playCount":10}')
    data = [tuple({**base, **r}[f.name] for f in KW.fields) for r in rows]
    return spark.createDataFrame(data, KW)
