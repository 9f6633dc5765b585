"""Dataset catalog: nested keys such as ``raw/orders`` with path templates."""

from __future__ import annotations

import string
import warnings
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from . import files


def list_datasets(catalog: dict, prefix: str = "") -> list[str]:
    """Keys of all entries, optionally below a prefix."""

    def walk(node: dict, at: str):
        for name, value in node.items():
            key = f"{at}/{name}" if at else name
            if isinstance(value, dict) and "uri" in value:
                yield key
            elif isinstance(value, dict):
                yield from walk(value, key)

    return [k for k in walk(catalog, "") if k.startswith(prefix)]


def entry(catalog: dict, key: str) -> dict:
    node = catalog
    for part in key.strip("/").split("/"):
        if not isinstance(node, dict) or part not in node:
            raise KeyError(f"no dataset {key!r} in the catalog")
        node = node[part]
    return node


def resolve(uri: str, args: dict) -> str:
    """Fill ``{name}`` fields: a missing argument is an error, an unused one a warning."""
    fields = {name for _, name, _, _ in string.Formatter().parse(uri) if name}
    missing, unused = fields - set(args), set(args) - fields
    if missing:
        raise ValueError(f"missing arguments {sorted(missing)} for {uri!r}")
    if unused:
        warnings.warn(f"unused arguments {sorted(unused)} for {uri!r}", stacklevel=2)
    return uri.format(**{k: args[k] for k in fields})


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, in name order (file-system metadata only)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(conf).globStatus(path)
    return sorted(str(f.getPath().toString()) for f in (found or []))


def load_dataset(spark: SparkSession, catalog: dict, key: str, skip: bool = False, **args) -> DataFrame:
    """Load one entry; a glob may match many datasets with the same column set.

    A dataset whose columns differ from the first one's is an error, or is left
    out with a warning when ``skip`` is set.  Only schemas are inspected here:
    accepted datasets of one schema are read lazily by one reader.
    """
    spec = entry(catalog, key)
    paths = expand(spark, resolve(spec["uri"], args))
    if not paths:
        raise FileNotFoundError(f"nothing matches {spec['uri']!r}")
    reader = {"csv": files.load_csv, "parquet": files.load_parquet}[spec["format"]]
    options = spec.get("driver_params", {})
    wanted: list[str] | None = None
    groups: dict[str, list[str]] = {}
    for path in paths:
        df = reader(spark, path, **options)
        wanted = wanted or df.columns
        if set(df.columns) != set(wanted):
            if not skip:
                raise ValueError(f"columns of {path} differ from those of {paths[0]}")
            warnings.warn(f"left out {path}: its columns differ", stacklevel=2)
            continue
        groups.setdefault(df.schema.json(), []).append(path)
    return reduce(DataFrame.unionByName, [reader(spark, group, **options) for group in groups.values()])


def save_dataset(df: DataFrame, catalog: dict, key: str, **args) -> None:
    spec = entry(catalog, key)
    writer = {"csv": files.save_csv, "parquet": files.save_parquet}[spec["format"]]
    writer(df, resolve(spec["uri"], args), **spec.get("driver_params", {}))
