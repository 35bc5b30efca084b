"""The derived inputs: cheap forms of their expressions give what the plain ones give."""

import contextlib
import io

from pyspark.sql import functions as F

from dwellmap.checks import fixtures
from dwellmap.session import prepare

SF_DIR = "/root/testdata/sf0.001"


def test_raw_rows_need_no_interpreted_steps(spark):
    raw = fixtures.raw(prepare(spark), SF_DIR)
    with contextlib.redirect_stdout(plan := io.StringIO()):
        raw.explain()
    assert "lambda" not in plan.getvalue() and "format_string" not in plan.getvalue()
    pings = fixtures.keyed_pings(spark, SF_DIR)
    written = raw.select("_c3", "_c4").distinct()
    formatted = pings.select(*[F.format_string("%.6f", c) for c in ("latitude", "longitude")]).distinct()
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, formatted.collect()))
