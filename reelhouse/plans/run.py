"""The layered run (K7) and layer selection (K8).

discover -> bronze (append, per dataset found) -> silver (rebuild all) -> gold
(rebuild all). Each layer reads the tables the previous one wrote, so every
layer starts from files in the warehouse, not from a long lineage, and a failed
layer can be re-run on its own. Plain function composition; no scheduler.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reelhouse import specs
from reelhouse.operators.checks import DECLARED, Check, run_checks
from reelhouse.plans import catalog, gold, silver, views
from reelhouse.sources import bronze, ingest, raw


def build_silver(spark: SparkSession, datasets: Sequence[str] | None = None,
                 on_bad: str = "fail", bronze_layer: str = "bronze",
                 silver_layer: str = "silver", missing: str = "raise") -> list[str]:
    """Rebuild ``silver_<dataset>`` from each bronze table. A bronze table that
    does not exist raises before anything is built; ``missing="skip"`` leaves
    its model out."""
    wanted = _present(spark, {ds: f"{bronze_layer}.{ds}" for ds in datasets or specs.DATASETS}, missing)
    built = []
    for ds in wanted:
        # Asked before the rows are read: a load that comes in between may be in the
        # table without being recorded, and is then folded once more, to the same rows.
        loads = unfolded_loads(spark, ds, bronze_layer, silver_layer)
        rows = spark.table(f"{bronze_layer}.{ds}")
        built.append(catalog.save_table(silver.SILVER_BUILDERS[ds](rows, on_bad), silver_layer, f"silver_{ds}").table)
        _record(spark, ds, loads, bronze_layer, silver_layer)
    return built


def _present(spark: SparkSession, inputs: dict[str, str], missing: str) -> list[str]:
    """The names whose input table exists; the others raise or are left out."""
    if missing not in ("raise", "skip"):
        raise ValueError("missing must be 'raise' or 'skip'")
    absent = sorted({t for t in inputs.values() if not spark.catalog.tableExists(t)})
    if absent and missing == "raise":
        raise ValueError(f"Input tables do not exist: {', '.join(absent)}")
    return [name for name, t in inputs.items() if t not in absent]


#: The loads of each bronze table that its silver table holds.
FOLDED = "folded_loads"
FOLDED_SCHEMA = "source string, load_id string"


def _record(spark: SparkSession, dataset: str, loads: list[str], bronze_layer: str, silver_layer: str) -> None:
    if loads:
        rows = [(f"{bronze_layer}.{dataset}", x) for x in loads]
        catalog.append_table(spark.createDataFrame(rows, FOLDED_SCHEMA).coalesce(1), silver_layer, FOLDED)


def unfolded_loads(spark: SparkSession, dataset: str, bronze_layer: str = "bronze",
                   silver_layer: str = "silver") -> list[str]:
    """Load ids of the bronze table that its silver table does not hold yet: an
    anti join of the table's partitions with the recorded loads. The names come
    to the driver (one for each load since the last build), no rows do."""
    loads = catalog.load_ids(spark, bronze_layer, dataset)
    if catalog.table_exists(spark, silver_layer, FOLDED):
        folded = spark.table(f"{silver_layer}.{FOLDED}").where(F.col("source") == f"{bronze_layer}.{dataset}")
        loads = loads.join(folded, catalog.LOAD_ID, "left_anti")
    return sorted(r[0] for r in loads.select(catalog.LOAD_ID).collect())


def build_gold(spark: SparkSession, silver_layer: str = "silver", gold_layer: str = "gold",
               as_view: bool = False, missing: str = "raise",
               names: Sequence[str] | None = None, failures: dict[Check, int] | None = None) -> list[str]:
    """Rebuild every gold mart (or those of ``names``), as tables (default) or as persistent views over
    the silver tables. A silver table that does not exist raises before anything
    is built; ``missing="skip"`` leaves its marts out. ``failures`` is given the counts
    of the declared checks that could be counted while the tables were written."""
    sources = {name: f"{silver_layer}.silver_{src}" for name, (src, _) in gold.GOLD_BUILDERS.items()
               if names is None or name in names}
    built = []
    for name in _present(spark, sources, missing):
        src, builder = gold.GOLD_BUILDERS[name]
        if as_view:
            built.append(views.create_gold_view(spark, name, silver_layer, gold_layer))
            continue
        df = builder(spark.table(f"{silver_layer}.silver_{src}"))
        saved = catalog.save_table(df, gold_layer, name, checks=[c for c in DECLARED if (c.layer, c.table) == ("gold", name)])
        built.append(saved.table)
        if failures is not None:
            failures.update(saved.failures)
    return built


def refresh_silver(spark: SparkSession, dataset: str, on_bad: str = "fail",
                   bronze_layer: str = "bronze", silver_layer: str = "silver") -> str:
    """Fold the bronze loads that ``silver_<dataset>`` does not hold yet into it;
    same result as a full rebuild, reading silver once, of bronze the partitions of
    those loads alone, and re-deduping only the keys that they touch.

    Keep-first picks the minimum of a total order per key, and a minimum can be
    taken in steps: dedupe(all bronze) = dedupe(silver so far + new rows). The
    NULL-key filter only removes whole key groups, so it commutes with that.
    A load that is folded twice changes nothing, so the loads are recorded after
    the table is replaced, and a run that dies in between is made good by the
    next. Without a silver table it is built from all of bronze.
    """
    name = f"silver_{dataset}"
    if not catalog.table_exists(spark, silver_layer, name):
        return build_silver(spark, [dataset], on_bad, bronze_layer, silver_layer)[0]
    loads = unfolded_loads(spark, dataset, bronze_layer, silver_layer)
    if loads:
        fresh = spark.table(f"{bronze_layer}.{dataset}").where(F.col(catalog.LOAD_ID).isin(*loads))
        current = spark.table(f"{silver_layer}.{name}")
        catalog.save_table(silver.fold(current, fresh, dataset, on_bad), silver_layer, name)
        _record(spark, dataset, loads, bronze_layer, silver_layer)
    return f"{silver_layer}.{name}"


LAYER_BUILDERS = {"silver": build_silver, "gold": build_gold}


def build(spark: SparkSession, layer: str, **kwargs) -> list[str]:
    """K8: rebuild one layer ("silver" or "gold")."""
    if layer not in LAYER_BUILDERS:
        raise ValueError(f"layer must be one of {sorted(LAYER_BUILDERS)}")
    return LAYER_BUILDERS[layer](spark, **kwargs)


def run(spark: SparkSession, raw_prefix: str, datasets: Sequence[str] | None = None,
        on_bad: str = "fail", drop_dir: str | None = None,
        ledger_table: str = "default.ingestion_runs", incremental: bool = False,
        glob: str = "*.csv", bucket: str = specs.DEFAULT_BUCKET,
        load_options: dict | None = None, load_id: str | None = None,
        now: dt.datetime | None = None) -> dict:
    """K7: upload the exports of ``drop_dir`` that match ``glob`` (then only
    their datasets are loaded, unless ``datasets`` names others; a file that is
    refused stops the run before anything is uploaded or loaded), else use what
    the raw zone has; load the newest raw file of each dataset into bronze, then
    rebuild silver and gold. Silver starts only after every bronze load
    finished. ``incremental`` folds the bronze loads that silver does not hold yet,
    of all datasets and whoever loaded them, into silver (``refresh_silver``)
    instead of rebuilding it from the whole append-only bronze history; the
    tables come out the same. ``load_options`` go to the bronze loads
    (``multi_line``, ``na_words``, ``numeric_text``). Models that this run did not
    bring up to date, for want of their input, are named under ``skipped``; the
    counts of the marts' checks that were taken while they were written, under
    ``failures`` (``check_layers`` runs all declared checks).

    ``load_id`` names the run's bronze loads, and ``now`` dates its uploads (both
    new by default): a run that was killed and is called again with the same two
    leaves each row once, in bronze and in the ledger."""
    catalog.ensure_layers(spark)
    opts = load_options or {}
    if drop_dir is not None:
        checked = raw.admit(raw.files_named(raw.list_drop(spark, drop_dir, glob)))
        refused = checked.where(~F.col("admitted")).limit(20).collect()
        if refused:
            raise ValueError("Upload failed, nothing was loaded: "
                             + "; ".join(f"{r['name']}: {r['reason']}" for r in refused))
        uploaded = ingest.upload_set(spark, drop_dir, glob)
        if uploaded:
            ingest.ingest(spark, drop_dir, raw_prefix, ledger_table, glob, bucket, now)
            datasets = uploaded if datasets is None else datasets
    loaded = bronze.load_all(spark, raw_prefix, datasets, load_id=load_id or uuid.uuid4().hex, **opts)
    if incremental:
        present = [ds for ds in specs.DATASETS if catalog.table_exists(spark, "bronze", ds)]
        silver_tables = [refresh_silver(spark, ds, on_bad) for ds in present]
    else:
        silver_tables = build_silver(spark, on_bad=on_bad, missing="skip")
    marts = [m for m, (ds, _) in gold.GOLD_BUILDERS.items() if f"silver.silver_{ds}" in silver_tables]
    failures: dict[Check, int] = {}
    gold_tables = build_gold(spark, names=marts, failures=failures)
    models = [f"silver.silver_{ds}" for ds in specs.DATASETS] + [f"gold.{m}" for m in gold.GOLD_BUILDERS]
    skipped = [m for m in models if m not in silver_tables and m not in gold_tables]
    return {"bronze": loaded, "silver": silver_tables, "gold": gold_tables, "skipped": skipped,
            "failures": {(c.table, c.column, c.check): n for c, n in failures.items()}}


def check_layers(spark: SparkSession, bronze_layer: str = "bronze",
                 gold_layer: str = "gold"):
    """Q4 over the stored tables: every declared check whose table exists
    (the checks run after a build, not inside it)."""
    layers = {"bronze": bronze_layer, "gold": gold_layer}
    tables = {}
    for c in DECLARED:
        name = f"{layers[c.layer]}.{c.table}"
        if (c.layer, c.table) not in tables and spark.catalog.tableExists(name):
            tables[(c.layer, c.table)] = spark.table(name)
    return run_checks(tables)
