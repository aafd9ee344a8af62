"""The merge job: a folder of module files -> normalised modules -> one parquet."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from strata.operators.modules import merge_modules, normalise_module
from strata.sources.files import modules_to_parquet, read_module_dir, write_parquet


@dataclass
class MergedFolder:
    """The parquet tables written, and the modules left out as they share no key."""

    written: list[str]
    skipped: list[str] = field(default_factory=list)


def merge_module_folder(spark: SparkSession, folder: str, out_dir: str, base_name: str, keys: Sequence[str] = (), sep: str = ",") -> MergedFolder:
    """Read every CSV module under ``folder`` with quotes repaired. With ``keys`` the
    modules are normalised on them (text without leading zeros, no blank key, one
    row a key), merged by full joins in the order of their names and written as
    ``<out_dir>/<BASE_NAME>.parquet``; without, each module is a parquet of its own.
    A module that shares no key with those before it is left out and reported.
    A folder without CSV files is an error."""
    if not keys:
        written = modules_to_parquet(spark, folder, out_dir, base_name, sep)
        if not written:
            raise ValueError(f"no CSV files under {folder}")
        return MergedFolder(written)
    modules = [(name, normalise_module(df, keys)) for name, df in read_module_dir(spark, folder, sep)]
    if not modules:
        raise ValueError(f"no CSV files under {folder}")
    merged = merge_modules(modules, keys, unique_on_keys=True)
    return MergedFolder([write_parquet(merged.frame, os.path.join(out_dir, f"{base_name.upper()}.parquet"))], merged.skipped)
