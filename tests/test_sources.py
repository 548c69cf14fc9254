"""Readers, staged tables and the published snapshot."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanewright.catalog.queries import Inputs, _kept_as_csv
from lanewright.sources import readers, staging
from lanewright.specs import SIDE_INPUTS


def test_side_input_with_header_offset(spark, rows, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(
        "Report for May,,,,\n"
        ",,,,\n"
        "Sent by planning,,,,\n"
        "Loc Code,ModelID,Loc Desc,NPD %,Unused\n"
        '01234,I_01234,"North, dock 4",0.25,x\n'
        "00777,,Dock,,y\n"
        ",,,,\n"
    )
    df = readers.read_side_input(spark, str(path), SIDE_INPUTS["renter_assumptions"])
    assert df.columns == ["loc_code", "model_id", "loc_desc", "npd_share"]
    assert ("01234", "I_01234", "North, dock 4", 0.25) in rows(df)
    assert ("00777", None, "Dock", None) in rows(df) and df.count() == 2


def test_side_input_from_typed_file(spark, rows, tmp_path):
    path = str(tmp_path / "rates")
    spark.createDataFrame(
        [("A to B", 12), ("C to D", None)], "`Lane Name` string, `Final Rate Award` int"
    ).write.parquet(path)
    df = readers.read_side_input(spark, path, SIDE_INPUTS["rfq_rates"], fmt="parquet")
    assert rows(df) == [("A to B", 12.0), ("C to D", None)]


def test_side_input_without_header_line(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("only one line\n")
    with pytest.raises(ValueError, match="no header"):
        readers.read_side_input(spark, str(path), SIDE_INPUTS["depot_assumptions"])


def test_model_is_typed_and_renamed(spark, rows, tmp_path):
    spark.createDataFrame(
        [(1, "P01", "21"), (2, "P02", ""), (3, "P03", "20.5")], "id int, period string, workingdays string"
    ).write.parquet(str(tmp_path / "periods"))
    model = readers.read_model(
        spark, str(tmp_path), ["periods"], column_names={"period": "periodname"}
    )
    assert rows(model["periods"]) == [("P01", 21.0), ("P02", None), ("P03", 20.5)]


def test_stage_cuts_lineage(spark, rows):
    stage = staging.Stage(spark)
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    out = stage.cut_all({"a": df, "b": df.filter("id > 5")})
    assert out["a"].count() == 10 and out["b"].count() == 4
    assert "Range" not in out["a"]._jdf.queryExecution().optimizedPlan().toString()


def test_shared_folder_is_read_from_the_session(spark):
    named = staging.shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir") == named
    assert staging.shared_folder(spark) == named


def test_failed_publish_leaves_the_old_snapshot(spark, rows, tmp_path):
    root = str(tmp_path / "model")
    good = spark.createDataFrame([("a", 1)], "k string, index int")
    assert staging.publish({"t": good, "u": good}, root) == {"t": 1, "u": 1}
    broken = good.withColumn("k", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(PySparkException):
        staging.publish({"t": good.limit(0), "u": broken}, root)
    current = staging.read_published(spark, root)
    assert rows(current["t"]) == [("a",)] and set(current) == {"t", "u"}
    staging.publish({"t": good.union(good)}, root)
    assert staging.read_published(spark, root)["t"].count() == 2
    assert staging.read_published(spark, root, back=1)["t"].count() == 1
    with pytest.raises(LookupError):
        staging.read_published(spark, root, back=2)


def test_database_read_must_be_partitioned(spark):
    with pytest.raises(ValueError, match="customers"):
        readers.read_model_jdbc(spark, "jdbc:x", ["customers", "periods"], partitioning={})


def test_rows_of_a_side_input_in_further_files(spark, rows, tmp_path):
    spec = SIDE_INPUTS["rfq_rates"]
    named = {new: old for old, new in spec.columns.items()}
    notes = "".join(f"note {k}\n" for k in range(spec.header_row))
    header = ",".join(f'"{named[c]}"' for c in ("lane_name", "rfqrate"))
    (tmp_path / "top.csv").write_text(f'{notes}{header}\n"A to B","1"\n')
    folder = tmp_path / "rows"
    folder.mkdir()
    (folder / "part-0.csv").write_text('"C to\nD","2.5"\n"say ""E""","x"\n')
    (folder / "part-1.csv").write_text(f'{header}\n"F to G",""\n')
    got = readers.read_side_input(spark, str(tmp_path / "top.csv"), spec, more=str(folder))
    assert rows(got, "lane_name", "rfqrate") == sorted(
        [("A to B", 1.0), ("C to\nD", 2.5), ('say "E"', None), (named["lane_name"], None), ("F to G", None)],
        key=repr,
    )


def test_no_task_writes_or_reads_a_whole_sheet(spark, sf_dir):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        with staging.Stage(spark) as stage:
            read = _kept_as_csv(Inputs(spark, sf_dir), stage, "depot_assignments")
            assert len(read.inputFiles()) > 2
    finally:
        spark.conf.set(setting, before)
