import json
import os

from wardstar.streaming.vitals import parse_vitals, read_vitals_stream, run_vitals

MSGS = [
    {"encounter_id": 1, "patient_nbr": 10, "timestamp": "2024-01-01T10:00:00", "heart_rate": 49,
     "spo2": 95, "extra": "ignored"},
    {"encounter_id": 2, "patient_nbr": 10, "timestamp": "2024-01-01T10:00:01", "heart_rate": 50,
     "spo2": 95},
    {"encounter_id": 3, "patient_nbr": 11, "timestamp": "2024-01-01T10:00:02", "heart_rate": 121,
     "spo2": 95},
    {"encounter_id": 4, "patient_nbr": 11, "timestamp": "bad time", "heart_rate": 80, "spo2": 89},
    {"encounter_id": 5, "patient_nbr": 12, "timestamp": "2024-01-01T10:00:04", "heart_rate": None,
     "spo2": 95},
]


def _write(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"part-{len(os.listdir(path))}.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_parse_batch(spark):
    lines = [json.dumps(m) for m in MSGS] + ["not json", '{"encounter_id": 6, "heart_rate": 70.0}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = {r.encounter_id: r for r in parse_vitals(df).collect() if r.encounter_id}
    assert rows[1].alert_flag is True and rows[2].alert_flag is False
    assert rows[4].event_time is None and rows[4].alert_reason == "Low blood oxygen (SpO2)"
    assert rows[5].alert_flag is None
    bad = parse_vitals(df).filter("is_malformed").count()
    assert bad == 2  # text and a float where an int belongs


def test_stream_two_sinks_restart(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _write(src, [json.dumps(m) for m in MSGS])
    args = (f"{tmp_dir}/all", f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt")
    raw = read_vitals_stream(spark, "text", path=src)
    run_vitals(spark, raw, *args, trigger={"availableNow": True}, wait=True)
    assert spark.read.parquet(f"{tmp_dir}/all").count() == 5
    assert sorted(r.encounter_id for r in spark.read.parquet(f"{tmp_dir}/alerts").collect()) \
        == [1, 3, 4]
    # restart on the same checkpoints with one new file: only new rows are added
    _write(src, [json.dumps({"encounter_id": 7, "heart_rate": 130, "spo2": 99})])
    raw = read_vitals_stream(spark, "text", path=src)
    run_vitals(spark, raw, *args, trigger={"availableNow": True}, wait=True)
    assert spark.read.parquet(f"{tmp_dir}/all").count() == 6
    assert spark.read.parquet(f"{tmp_dir}/alerts").count() == 4


def test_stream_single_read_restart(spark, tmp_dir):
    from wardstar.streaming.vitals import run_vitals_single_read
    src = f"{tmp_dir}/src"
    _write(src, [json.dumps(m) for m in MSGS])
    args = (f"{tmp_dir}/all", f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt")
    raw = read_vitals_stream(spark, "text", path=src)
    run_vitals_single_read(spark, raw, *args, trigger={"availableNow": True}, wait=True)
    assert spark.read.parquet(f"{tmp_dir}/all").count() == 5
    got = spark.read.parquet(f"{tmp_dir}/alerts")
    assert "batch_id" in got.columns
    assert sorted(r.encounter_id for r in got.collect()) == [1, 3, 4]
    # restart on the same checkpoint with one new file: only the new batch is added
    _write(src, [json.dumps({"encounter_id": 7, "heart_rate": 130, "spo2": 99})])
    raw = read_vitals_stream(spark, "text", path=src)
    run_vitals_single_read(spark, raw, *args, trigger={"availableNow": True}, wait=True)
    assert spark.read.parquet(f"{tmp_dir}/all").count() == 6
    assert spark.read.parquet(f"{tmp_dir}/alerts").count() == 4


def test_default_trigger_and_await_any(spark, tmp_dir):
    from wardstar.streaming.vitals import await_any
    src = f"{tmp_dir}/src"
    _write(src, [json.dumps(m) for m in MSGS])
    raw = read_vitals_stream(spark, "text", path=src)
    qs = run_vitals(spark, raw, f"{tmp_dir}/all", f"{tmp_dir}/alerts", f"{tmp_dir}/ckpt")
    try:
        for q in qs:
            q.processAllAvailable()
        _write(src, [json.dumps({"encounter_id": 8, "heart_rate": 40})])
        for q in qs:
            q.processAllAvailable()
        assert spark.read.parquet(f"{tmp_dir}/all").count() == 6
        assert spark.read.parquet(f"{tmp_dir}/alerts").where("encounter_id = 8").count() == 1
        spark.streams.resetTerminated()
        assert await_any(spark, 1) is False   # both still run
    finally:
        for q in qs:
            q.stop()
    assert await_any(spark, 20) is True
