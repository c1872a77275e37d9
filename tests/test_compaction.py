import json
from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pavelens.operators import compaction
from pavelens.session import Scratch

SCHEMA = "file_id long, table_name string, written_at timestamp, payload string, bin string"


@given(st.lists(st.integers(0, 150), max_size=60))
def test_first_fit_decreasing_against_the_plain_rule(sizes):
    free, want = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        need = min(sizes[i], 100)
        k = next((k for k, f in enumerate(free) if f >= need), len(free))
        if k == len(free):
            free.append(100)
        free[k] -= need
        want[i] = k
    assert compaction.first_fit_decreasing(sizes, 100) == want


def _row(i, table, payload, day=1):
    return (i, table, datetime(2024, 1, day), payload, "clash")


def test_every_record_once(spark, tmp_path):
    a = lambda k, **x: json.dumps({"area_id": k, "fk": "A", **x})
    rows = [
        _row(1, "Strassenzustand", a(1) + "\n" + a(2) + "\r\n" + a(3)[:-4]), _row(2, "Strassenzustand", a(2, bw="P"), 2), _row(3, "Strassenzustand", ""),
        _row(4, "Strassenzustand", None), _row(5, "Substance", '{"substance_id": 1, "typ": null}'), _row(6, "Substance", '{"area_id": 9}\n[1]\nnull\n{}\n{"substance_id": "x"}'),
        _row(7, "Other", a(7)), _row(8, None, a(8)), (9, "Strassenzustand", None, a(10) + "\n" + a(10), "clash"), _row(10, "Strassenzustand", a(1)), _row(10, "Strassenzustand", a(1)), _row(11, "Substance", '{"substance_id": 5}' + " " * 300_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    done = compaction.compact(df, f"file://{tmp_path}/t", target_bytes=60)
    got = {(r["table_name"], r["record_id"]): r["line"] for r in done.data.collect()}
    assert set(got) == {("Strassenzustand", 1), ("Strassenzustand", 2), ("Strassenzustand", 10), ("Substance", 1), ("Substance", 5)}
    assert done.data.count() == done.n_records == 5
    assert json.loads(got["Strassenzustand", 2])["bw"] == "P"  # the newest writing
    again = compaction.compact(df.limit(0), f"file://{tmp_path}/t", 60)
    assert again.version == 2 and compaction.read_compacted(spark, f"file://{tmp_path}/t").count() == 0
    assert compaction.read_compacted(spark, f"file://{tmp_path}/t", 1).count() == 5


def test_a_failed_check_commits_nothing(spark, tmp_path, monkeypatch):
    sums = compaction._sums
    cut = lambda df, content: sums(df.withColumn("line", F.expr("left(line, length(line) - 1)")) if "line" in df.columns else df, content)
    monkeypatch.setattr(compaction, "_sums", cut)  # a line cut short on the way
    with pytest.raises(RuntimeError, match="differ in 1 of 1 bins"):
        compaction.compact(spark.createDataFrame([_row(1, "Substance", '{"substance_id": 1}')], SCHEMA), f"file://{tmp_path}/t", 60)
    assert compaction.versions(spark, f"file://{tmp_path}/t") == []
    with pytest.raises(FileNotFoundError):
        compaction.read_compacted(spark, f"file://{tmp_path}/t")


def test_waves_and_repeated_writings(spark, tmp_path):
    line = lambda k, n: json.dumps({"area_id": k, "n": n})
    rows = [_row(f, "Strassenzustand", "\n".join(line(k % 40, f) for k in range(f, f + 9)), 1 + f % 3) for f in range(60)] + [_row(70, "Strassenzustand", line(1, 1) + "\n" + line(1, 2) + "\n" + line(1, 1), 9)]
    want = {}
    for f, _, day, payload, _ in rows:
        for x in payload.split("\n"):
            k = json.loads(x)["area_id"]
            if k not in want or (day, f) >= want[k][0]:
                want[k] = ((day, f), want[k][1] | {x} if k in want and want[k][0] == (day, f) else {x})
    for wave in (1_000, 3):
        done = compaction.compact(spark.createDataFrame(rows, SCHEMA), f"file://{tmp_path}/w{wave}", target_bytes=500, wave_bins=wave)
        got = done.data.collect()
        assert len(got) == len({r["record_id"] for r in got}) == 40 and all(r["line"] in want[r["record_id"]][1] for r in got)
        assert done.files_out == len({(r["table_name"], r["bin"]) for r in got}) > 9
        files = [p for p in tmp_path.glob(f"w{wave}/data/*/table_name=*/bin=*/*.parquet")]
        assert len(files) == done.files_out  # one file a bin


def test_one_writer_wins(spark, tmp_path, monkeypatch):
    at = f"file://{tmp_path}/t"
    compaction.compact(spark.createDataFrame([_row(1, "Substance", '{"substance_id": 1}')], SCHEMA), at, 60)
    claim = tmp_path / "t" / "_commits" / f"{2:012d}.claim"
    claim.touch()
    with pytest.raises(RuntimeError, match="another writer"):
        compaction._commit(spark, at, {"data": "x"})
    monkeypatch.setattr(compaction, "CLAIM_SECONDS", -1)  # its writer died
    assert compaction._commit(spark, at, {"data": "x"}) == 2 and not claim.exists()


def test_files_of_a_folder(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(json.dumps({"area_id": i}))
    files = compaction.manifest_from_directory(spark, str(tmp_path), "Strassenzustand", "*.json")
    assert compaction.compact(files, Scratch(spark, "t").path("out")).data.count() == 5
    assert compaction.file_plan(files, 40).agg({"n_files": "sum"}).first()[0] == 5
