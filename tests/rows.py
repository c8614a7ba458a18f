"""Hand-made rows for the three logical tables."""

from datetime import datetime

from weirwalk import schema
from weirwalk.fixed_values import site_names

GOJ, LMJ, ICH, MCJ, JDJ = (
    site_names(code)[0] for code in ("GOJ", "LMJ", "ICH", "MCJ", "JDJ")
)


def day(month, number, year=2014):
    return datetime(year, month, number, 12)


def detection(tag, site, when, antenna="RIVER EXIT", year=2014, source="main", group="CHK"):
    return (tag, site, antenna, when, year, source, group)


def tagged(tag, run="Spring", release=datetime(2014, 3, 1), age=None, source="main", group=None):
    return (tag, run, release, age, source, group)


def state(tag, dam, spp=None, upstream=None, at_dam=None, below=None, basin="clearwater", run="CH1"):
    return (basin, run, dam, tag, spp, None, None, None, upstream, at_dam, below)


def frames(spark, detections, tagging, passage):
    return (
        spark.createDataFrame(detections, schema.DETECTIONS),
        spark.createDataFrame(tagging, schema.TAGGING),
        spark.createDataFrame(passage, schema.PASSAGE),
    )
