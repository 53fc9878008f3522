"""spark-submit levelscope/jobs/correct.py --config correction.json

The JSON holds ``source`` (format, path, options), ``output_path`` and, as ``correction``, the fields of
:class:`levelscope.config.CorrectionConfig`. With ``take_over`` a run goes on from one with the same
settings that was killed. With ``increment`` the source holds further events for finished outputs.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from levelscope.config import CorrectionConfig
from levelscope.functions.payload import parsed_payloads
from levelscope.operators.correction import history_window, milestone_cutoffs
from levelscope.operators.quality import refuse_null_timestamps
from levelscope.plans.correct import correct_history
from levelscope.plans.increment import increment
from levelscope.session import amended, exists, published, remove, run_key, scratch, use_utc
from levelscope.sources.gates import raw_gate
from levelscope.sources.readers import read_corrected, read_raw
from levelscope.sources.records import merged_facts, replace_records, table_record
from levelscope.sources.sinks import write_corrected, write_cutoffs, write_days


def layout(settings: dict) -> dict:
    """How the days are laid out: ``rebalance``, ``cluster``, ``row_group_bytes``."""
    return {
        "rebalance": settings.get("rebalance", True),
        "cluster": settings.get("cluster", False),
        "row_group_bytes": settings.get("row_group_bytes"),
    }


def with_payloads(corrected: DataFrame, settings: dict) -> DataFrame:
    """``payloads`` is ``as_is`` or ``variant``: JSON text is then parsed once, here."""
    kind = settings.get("payloads", "as_is")
    if kind not in ("as_is", "variant"):
        raise ValueError(f"payloads must be as_is or variant, not {kind}")
    return parsed_payloads(corrected) if kind == "variant" else corrected


def run(spark: SparkSession, settings: dict) -> str:
    """Write ``raw_fixed`` and ``user_clear650_cutoffs`` below the output path, and then the marker
    that both are complete."""
    use_utc(spark)
    source = settings["source"]
    cfg = CorrectionConfig(**settings["correction"])
    root = settings["output_path"].rstrip("/")

    raw = read_raw(spark, source["path"], source.get("format", "parquet"), source.get("options"))
    refuse_null_timestamps(raw_gate(raw), cfg)  # before the first output

    # The cutoff table is an output of its own; the correction goes on from the written one.
    run = run_key({name: value for name, value in settings.items() if name != "take_over"})
    with published(spark, root, run, settings.get("take_over", False)) as mode:
        cutoffs = milestone_cutoffs(history_window(raw, cfg), cfg)
        write_cutoffs(cutoffs, f"{root}/user_clear650_cutoffs", mode)
        written = spark.read.schema(cutoffs.schema).parquet(f"{root}/user_clear650_cutoffs")

        corrected = correct_history(raw, cfg, cutoffs=written)
        write_corrected(with_payloads(corrected, settings), f"{root}/raw_fixed", mode=mode, **layout(settings))
    return f"{root}/raw_fixed"


def run_increment(spark: SparkSession, settings: dict) -> str:
    """Brings the outputs of an earlier run up to date with further raw events (``source``): the cutoff
    table, and the days that new events or changed cutoffs touch.

    All that is to be written is written aside first, while the outputs stay as they are; only then are they
    replaced, which can be done again if it is interrupted. The same settings are not applied twice.
    """
    use_utc(spark)
    source = settings["source"]
    cfg = CorrectionConfig(**settings["correction"])
    root = settings["output_path"].rstrip("/")
    fixed_path, cutoff_path = f"{root}/raw_fixed", f"{root}/user_clear650_cutoffs"
    key = run_key({name: value for name, value in settings.items() if name != "take_over"})
    aside = f"{root}/_increment/{key}"

    with amended(spark, root, key, settings.get("take_over", False)) as outputs, scratch(spark):
        ready = f"{aside}/_READY"
        if not exists(spark, ready):
            remove(spark, aside)
            raw = read_raw(spark, source["path"], source.get("format", "parquet"), source.get("options"))
            record = table_record(spark, fixed_path)
            before = read_corrected(spark, fixed_path)
            cutoffs = spark.read.parquet(cutoff_path)
            change = increment(before, cutoffs, with_payloads(raw, settings), cfg)
            columns = {**{f.name: f for f in before.schema}, **{f.name: f for f in change.days.schema}}
            write_cutoffs(change.cutoffs, f"{aside}/cutoffs")
            write_corrected(change.days, f"{aside}/days", **layout(settings))
            written = table_record(spark, f"{aside}/days")
            earlier = record.facts if record and record.facts else ({},)
            note = {
                "schema": json.loads(T.StructType(list(columns.values())).json()),
                "facts": merged_facts(*earlier, *written.facts) if written.facts else {},
            }
            spark.createDataFrame([(json.dumps(note),)], "note string").coalesce(1).write.text(ready)
        note = json.loads(spark.read.text(ready).first()[0])
        outputs.incomplete()
        days = read_corrected(spark, f"{aside}/days")
        write_days(days, fixed_path)
        write_cutoffs(spark.read.parquet(f"{aside}/cutoffs"), cutoff_path, "overwrite")
        replace_records(spark, fixed_path, T.StructType.fromJson(note["schema"]), note["facts"])
    remove(spark, f"{root}/_increment")
    return fixed_path


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", required=True)
    with open(parser.parse_args().config, encoding="utf-8") as handle:
        settings = json.load(handle)
    spark = SparkSession.builder.appName("levelscope-correct").getOrCreate()
    try:
        work = run_increment if settings.get("increment") else run
        print("corrected events:", work(spark, settings))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
