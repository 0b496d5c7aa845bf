import datetime as dt
from decimal import Decimal

import pytest

from planact import schemas
from planact.session import build_session
from planact.plans.inputs import Inputs


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def day(text):
    return dt.date.fromisoformat(text)


class Make:
    """Small tables from tuples."""

    def __init__(self, spark):
        self.spark = spark

    def materials(self, *rows):
        return self.spark.createDataFrame(list(rows), schemas.MATERIAL)

    def movements(self, *rows):
        """(material, day, class, place, kg)"""
        data = [(f"d{i}", m, f"L{m}", day(d), c, p, float(kg)) for i, (m, d, c, p, kg) in enumerate(rows)]
        return self.spark.createDataFrame(data, schemas.MOVEMENT)

    def plan(self, *rows, stamp="2024-01-01"):
        """(version, material, month, measure, value)"""
        at = dt.datetime.fromisoformat(stamp)
        data = [(v, m, day(mo), me, None if x is None else Decimal(str(x)), at) for v, m, mo, me, x in rows]
        return self.spark.createDataFrame(data, schemas.PLAN_FACT)

    def shutdown(self, *rows, stamp="2024-01-01"):
        """(version, day, measure, hours)"""
        at = dt.datetime.fromisoformat(stamp)
        return self.spark.createDataFrame([(v, day(d), me, float(h), at) for v, d, me, h in rows], schemas.SHUTDOWN_FACT)

    def telemetry(self, *rows):
        """(timestamp, run, feed, coal, dust set, dust out, slag)"""

        def cell(x):
            return None if x is None else Decimal(str(x))

        data = [
            (dt.datetime.fromisoformat(t), cell(r), cell(f), cell(c), cell(ds), None, cell(do), cell(s))
            for t, r, f, c, ds, do, s in rows
        ]
        return self.spark.createDataFrame(data, schemas.TELEMETRY)

    def inputs(self, materials=(), movements=(), plan=(), shutdown=(), telemetry=()):
        return Inputs(
            self.materials(*materials),
            self.movements(*movements),
            self.plan(*plan),
            self.shutdown(*shutdown),
            self.telemetry(*telemetry),
        )


@pytest.fixture(scope="session")
def make(spark):
    return Make(spark)


def rows(df, *order):
    """Collected rows as plain tuples, decimals as floats, sorted."""
    found = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in df.select(*(order or df.columns)).collect()]
    return sorted(found, key=repr)
