import os

import pytest

from wardstar.operators.quality import check_rejects
from wardstar.sources.encounters import ENCOUNTER_SCHEMA, count_lines, scan_encounters

NAMES = [f.name for f in ENCOUNTER_SCHEMA.fields]


def line(columns, **values):
    row = {c: "1" for c in NAMES} | {"extra": "e"} | {k: str(v) for k, v in values.items()}
    return ",".join(row[c] for c in columns)


def write(folder, name, columns, lines, head=True):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(([",".join(columns)] if head else []) + lines) + "\n")


def test_every_line_is_kept_or_rejected(spark, tmp_dir):
    path = f"{tmp_dir}/in"
    back = [*NAMES[::-1], "extra"]
    short = [c for c in NAMES if c not in ("diag_2", "readmitted")]
    write(path, "a.csv", NAMES, [line(NAMES, encounter_id=1, diag_1="250.83"), line(NAMES, encounter_id="two"),
                                 line(NAMES, encounter_id=3, time_in_hospital="4 days"), "", "5,6",
                                 line(NAMES, encounter_id=6, weight="")])
    write(path, "b.csv", back, [line(back, encounter_id=7, diag_1='"V45, x"'), line(back, encounter_id=8) + ",more"])
    write(path, "c.csv", short, [line(short, encounter_id=9), line(short, encounter_id=10)])
    write(path, "d.csv", NAMES, [line(NAMES, encounter_id=11)], head=False)
    kept, rejected = scan_encounters(spark, path)
    got = {r.encounter_id: r for r in kept.collect()}
    assert set(got) == {1, 6, 7} and kept.columns == NAMES
    assert got[1].diag_1 == "250.83" and got[7].diag_1 == "V45, x" and got[6].weight is None
    bad = sorted((os.path.basename(r.file), r.reason) for r in rejected.collect())
    assert bad == [("a.csv", "malformed")] * 3 + [("b.csv", "malformed")] + \
        [("c.csv", "header lacks diag_2, readmitted")] * 2 + [("d.csv", "no header")]
    assert any(r.line == "5,6" for r in rejected.collect())
    n = count_lines(spark, path)
    assert n == 10 == kept.count() + rejected.count()
    assert check_rejects(rejected, "enc", n, kept, 80.0).first().passed is True
    assert check_rejects(rejected, "enc", n, kept, 10.0).first().failures == 7
    assert check_rejects(rejected, "enc", n + 1, kept, 80.0).first().passed is False


def test_a_folder_with_headers_only(spark, tmp_dir):
    write(f"{tmp_dir}/in", "a.csv", NAMES, [])
    kept, rejected = scan_encounters(spark, f"{tmp_dir}/in")
    assert kept.count() == rejected.count() == count_lines(spark, f"{tmp_dir}/in") == 0


@pytest.mark.parametrize("size", [0, 400])
def test_sigmoid_by_sums_equals_the_regression(spark, size):
    import random

    from wardstar.plans.model import _platt, platt_sums
    rng = random.Random(size)
    rows = [(int(rng.random() < 1 / (1 + 2.7 ** (2 - 5 * s))), s) for s in (rng.random() for _ in range(size))]
    df = spark.createDataFrame(rows, "readmitted_30d int, score double")
    if not size:
        assert platt_sums(df) == (0.0, 0.0)
        return
    a, b = platt_sums(df)
    c, d = _platt(df)
    assert abs(a - c) < 1e-4 and abs(b - d) < 1e-4
    one = spark.createDataFrame([(1, 0.5)] * 20, "readmitted_30d int, score double")
    p = platt_sums(one)
    assert abs(1 / (1 + 2.718281828 ** -(p[0] * 0.5 + p[1])) - 21 / 22) < 1e-4
