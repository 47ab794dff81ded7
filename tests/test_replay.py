"""Replay of recorded outputs of the reference's ratings jobs.

The recorded outputs determine their own input: every movie has exactly two
ratings, one by a male and one by a female user, and the age-band means tell
which band each of the two users is in.  The rating rows are rebuilt from the
recorded gender and band lines; the jobs must then reproduce all three
recorded outputs line for line in the reference's text formats.
"""

import os
import re

import pytest

from tessera.functions.bands import RIGHT_CLOSED_AGE_EDGES, RIGHT_CLOSED_AGE_LABELS
from tessera.plans import ratings as R
from tessera.plans import reports as RP

HERE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
# one representative age inside each right-closed band
AGE_OF_BAND = {"0-18": 10, "18-35": 30, "35-50": 40, "50+": 60}


def _lines(name):
    with open(os.path.join(HERE, name), encoding="utf-8") as f:
        return [ln.rstrip("\n") for ln in f if ln.strip()]


def _rebuild():
    seg = {}
    for ln in _lines("recorded_segment_means.txt"):
        m = re.match(r"^(.*):\tMale: ([0-9.]+), Female: ([0-9.]+)$", ln)
        seg[m.group(1)] = (float(m.group(2)), float(m.group(3)))
    bands = {}
    for ln in _lines("recorded_band_means.txt"):
        m = re.match(r"^(.*):\t\[(.*)\]$", ln)
        vals = dict(p.split(": ") for p in m.group(2).split(", "))
        bands[m.group(1)] = {k: float(v) for k, v in vals.items() if v != "NA"}
    ratings, users, items = [], [], []
    for n, (title, (male, female)) in enumerate(seg.items()):
        item = f"{1000 + n}"
        items.append((item, title))
        known = bands[title]
        if len(known) == 1:
            (b,) = known
            b_m = b_f = b
        else:
            # two bands: one user in each, the one whose mean equals its rating
            b_m = next(b for b, v in known.items() if v == male)
            b_f = next(b for b, v in known.items() if v == female and b != b_m)
        for g, score, b in (("M", male, b_m), ("F", female, b_f)):
            user = f"u{len(users)}"
            users.append((user, g, str(AGE_OF_BAND[b])))
            ratings.append((user, item, score))
    return ratings, users, items


@pytest.fixture(scope="module")
def frames(spark):
    ratings, users, items = _rebuild()
    r = spark.createDataFrame(ratings, "user_id string, item_id string, score double")
    u = spark.createDataFrame(users, "user_id string, segment string, age string")
    i = spark.createDataFrame(items, "item_id string, title string")
    return r, u, i


def test_item_means_replay(frames):
    r, u, i = frames
    out = RP.item_mean_lines(R.item_avg_score(r, i, digits=None)).select("line")
    assert sorted(x[0] for x in out.collect()) == sorted(_lines("recorded_item_means.txt"))
    # no movie has 5 ratings: the winner job returns no row at all
    assert R.best_item_min_support(r, i, 5).count() == 0


def test_segment_means_replay(frames):
    r, u, i = frames
    wide = R.item_avg_by_segment_wide(r, u, i, ["M", "F"], ["male", "female"], fill=0.0,
                                      digits=None)
    out = RP.segment_means_lines(wide).select("line")
    assert sorted(x[0] for x in out.collect()) == sorted(_lines("recorded_segment_means.txt"))


def test_band_means_replay(frames):
    r, u, i = frames
    names = ["b1", "b2", "b3", "b4"]
    wide = R.item_avg_by_band_wide(r, u, i, RIGHT_CLOSED_AGE_EDGES, RIGHT_CLOSED_AGE_LABELS,
                                   names, digits=None)
    out = RP.band_means_lines(wide, RIGHT_CLOSED_AGE_LABELS, names).select("line")
    assert sorted(x[0] for x in out.collect()) == sorted(_lines("recorded_band_means.txt"))
