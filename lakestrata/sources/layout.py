"""Lake layout: where raw, standardized and refined tables live.

Raw and standardized tables are daily full snapshots under
``{bucket}/{area}/{system}/{endpoint}/{yyyyMMdd}/{endpoint}_{yyyyMMdd}.{ext}``; refined
tables are current state under ``{bucket}/{area}/{context}/{table}.parquet``. A "bucket"
is any Hadoop-FS folder (``s3a://``, ``abfss://``, ``hdfs://`` or local).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from lakestrata.fixed import RAW_BUCKET, RAW_CONTEXT, REFINED_BUCKET, STANDARDIZED_BUCKET


def date_key(day: str | _dt.date | _dt.datetime | None = None) -> str:
    """``yyyyMMdd`` for a date (default: today, evaluated at call time)."""
    if day is None:
        day = _dt.date.today()
    if isinstance(day, (_dt.date, _dt.datetime)):
        return day.strftime("%Y%m%d")
    _dt.datetime.strptime(day, "%Y%m%d")  # validates
    return day


@dataclass(frozen=True)
class LakeLayout:
    """Paths of the three layers under one root folder."""

    root: str

    def bucket(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw_root(self) -> str:
        return self.bucket(RAW_BUCKET)

    @property
    def standardized_root(self) -> str:
        return self.bucket(STANDARDIZED_BUCKET)

    @property
    def refined_root(self) -> str:
        return self.bucket(REFINED_BUCKET)

    def raw(self, area: str, endpoint: str, day: str | _dt.date | None = None,
            ext: str = "json", system: str = RAW_CONTEXT) -> str:
        d = date_key(day)
        return f"{self.raw_root}/{area}/{system}/{endpoint}/{d}/{endpoint}_{d}.{ext}"

    def standardized(self, area: str, endpoint: str, day: str | _dt.date | None = None,
                     system: str = RAW_CONTEXT, ext: str = "parquet") -> str:
        d = date_key(day)
        return f"{self.standardized_root}/{area}/{system}/{endpoint}/{d}/{endpoint}_{d}.{ext}"

    def standardized_table(self, area: str, endpoint: str, system: str = RAW_CONTEXT) -> str:
        return f"{self.standardized_root}/{area}/{system}/{endpoint}"

    def refined(self, area: str, table: str, context: str = RAW_CONTEXT) -> str:
        return f"{self.refined_root}/{area}/{context}/{table}.parquet"
