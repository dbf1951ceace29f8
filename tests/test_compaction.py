import os

from test_streaming import MSGS, _write

from wardstar.streaming.compaction import compact, committed_batch, read_sink, remove_compacted
from wardstar.streaming.vitals import read_vitals_stream, run_vitals_single_read


def n_files(folder):
    return sum(f.endswith(".parquet") for _, _, fs in os.walk(folder) for f in fs)


def test_rows_stay_and_files_become_fewer(spark, tmp_dir):
    import json
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/all", f"{tmp_dir}/ckpt"

    def run(lo, hi):
        for i in range(lo, hi):
            _write(src, [json.dumps({**MSGS[i % 5], "encounter_id": i})])
        raw = read_vitals_stream(spark, "text", {"maxFilesPerTrigger": "1"}, src)
        run_vitals_single_read(spark, raw, sink, f"{tmp_dir}/alerts", ckpt, trigger={"availableNow": True}, wait=True)

    def ids():
        return sorted(r.encounter_id for r in read_sink(spark, sink).collect())
    assert committed_batch(spark, f"{ckpt}/both") == -1
    run(0, 6)
    assert ids() == list(range(6)) and committed_batch(spark, f"{ckpt}/both") == 5
    before = n_files(sink)
    assert compact(spark, sink, f"{ckpt}/both") == 6
    assert ids() == list(range(6))          # both stand side by side
    assert compact(spark, sink, f"{ckpt}/both") == 0
    assert remove_compacted(spark, sink) == 6
    assert ids() == list(range(6)) and n_files(sink) < before
    # the stream goes on, a batch that is not committed is not compacted
    run(6, 9)
    spark.createDataFrame([], read_sink(spark, sink).drop("batch_id").schema).write.parquet(f"{sink}/batch_id=9")
    assert ids() == list(range(9))
    assert compact(spark, sink, f"{ckpt}/both") == 3
    assert ids() == list(range(9)) and remove_compacted(spark, sink) == 3
    assert os.path.isdir(f"{sink}/batch_id=9")
    batches = {r.encounter_id: r.batch_id for r in read_sink(spark, sink).collect()}
    assert sorted(batches.values()) == list(range(9))
