"""File areas with real files."""

from wattloom.sources import transfer


def put(root, key, size):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"x" * size)


def test_reconcile_real_files(spark, tmp_path):
    put(tmp_path, "incoming/a.parquet", 10)
    put(tmp_path, "incoming/b.parquet", 20)
    put(tmp_path, "incoming/c.parquet", 30)
    put(tmp_path, "landing/ingest_date=2018-01-02/a.parquet", 10)
    put(tmp_path, "landing/ingest_date=2018-01-03/a.parquet", 99)
    put(tmp_path, "landing/ingest_date=2018-01-03/b.parquet", 20)
    put(tmp_path, "landing/ingest_date=2018-01-03/d.parquet", 5)
    put(tmp_path, "archive/processed_date=2018-01-02/a.parquet", 10)
    put(tmp_path, "archive/processed_date=2018-01-02/b.parquet", 21)
    areas = [transfer.list_area(spark, str(tmp_path / n)) for n in ("incoming", "landing", "archive")]
    rows = {r.file_name: r for r in transfer.reconcile(*areas).collect()}
    assert {n: r.safe_to_remove for n, r in rows.items()} == {
        "a.parquet": True,
        "b.parquet": False,
        "c.parquet": False,
        "d.parquet": False,
    }
    assert rows["b.parquet"].landing_matches and not rows["b.parquet"].archive_matches
    assert not rows["d.parquet"].in_incoming
    assert transfer.next_file(areas[0]).first().key.endswith("incoming/a.parquet")
    plan = areas[0]._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
