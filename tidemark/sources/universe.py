"""Universe of companies from a configuration."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM_FIELDS = ("symbol", "full_name", "exchange", "sector", "query")
INHERITED_FIELDS = ("interval", "period", "start_date", "end_date", "display", "start", "timeout")


def inherit_defaults(items: DataFrame, defaults: Mapping[str, object], as_of: str) -> DataFrame:
    """Fills what an item leaves open from the defaults; the end date TODAY becomes `as_of`."""
    filled = {}
    for name, value in defaults.items():
        default = F.lit(None if value is None else str(value))
        own = F.col(name).cast("string") if name in items.columns else F.lit(None).cast("string")
        filled[name] = F.coalesce(own, default)
    out = items.withColumns(filled)
    if "end_date" in out.columns:
        out = out.withColumn("end_date", F.when(F.col("end_date") == "TODAY", F.lit(as_of)).otherwise(F.col("end_date")))
    return out


def read_universe_config(path: str) -> dict:
    """The `data_pipelines` section of a configuration file; an external stocks file overrides its items."""
    import yaml

    with open(path, encoding="utf-8") as f:
        section = yaml.safe_load(f)["data_pipelines"]
    extra = section.get("stocks_file")
    if extra:
        extra_path = os.path.join(os.path.dirname(path), extra)
        if os.path.exists(extra_path):
            with open(extra_path, encoding="utf-8") as f:
                section["stocks"] = (yaml.safe_load(f) or {}).get("stocks", section.get("stocks"))
    return section


def load_universe(spark: SparkSession, section: Mapping, as_of: str) -> DataFrame:
    """One row per item with a symbol or query; a configuration is a short hand-written list."""
    items = section.get("stocks", section.get("companies"))
    if items is None:
        raise ValueError("the configuration needs 'stocks' or 'companies'")
    fields = [*ITEM_FIELDS, *INHERITED_FIELDS]
    usable = [i for i in items if i.get("symbol") or i.get("query")]
    rows = [tuple(None if i.get(f) is None else str(i[f]) for f in fields) for i in usable]
    frame = spark.createDataFrame(rows, ", ".join(f"{f} STRING" for f in fields))
    filled = inherit_defaults(frame, {f: section.get(f) for f in INHERITED_FIELDS}, as_of)
    return filled.withColumn("search", F.coalesce("query", "symbol"))
