import threading

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from mixloom.sources import staging
from mixloom.sources.schemas import TABLES
from mixloom.sources.warehouse import Warehouse, report


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / f"{name.upper()}.csv").write_text(text)


@pytest.fixture
def batch(tmp_path):
    folder = tmp_path / "one"
    put(folder, "category", "category_id,category_name\nC1,Snacks\nC2,Soap\nC1,Snacks\n,Nameless\n")
    put(folder, "product", "product_id,category_id,brand,sku_name\nP1,C1,A,\"Bar, big\"\nP2,C9,A,Lost\nP3,,B,Free\n")
    put(folder, "price_change", "product_id,year,week,unit_price\nP1,2025,1,3.5\nP1,2025,1,3.0\nP1,2025,2,dear\nP2,2025,1,9.0\n")
    put(
        folder,
        "promotion",
        "promo_id,promo_type,start_date,end_date,discount_value\nX,PCT_OFF,2025-01-01,29-01-2025,10.0\nY,BOGO,soon,2025-02-01,\n",
    )
    put(folder, "channel", "channel_id,name\nW,web\n")
    return folder


NAMES = ["category", "product", "price_change", "promotion", "channel"]


def test_checks_merges_and_quarantines(spark, tmp_path, batch):
    house = Warehouse(spark, str(tmp_path / "house"))
    got = {x.table: x for x in house.ingest(str(batch), reversed(NAMES))}
    assert list(got) == [n for n in TABLES if n in NAMES]
    assert (got["category"].read, got["category"].inserted, got["category"].duplicate) == (4, 2, 1)
    assert got["category"].quarantined == {"null_key": 1}
    assert got["product"].quarantined == {"orphan:category_id": 1} and got["product"].inserted == 2
    # P2 never got in, so its price is an orphan; of two prices of one week the smaller stays.
    assert got["price_change"].quarantined == {"bad_value": 1, "orphan:product_id": 1}
    assert [tuple(r) for r in house.table("price_change").collect()] == [("P1", 2025, 1, 3.0)]
    assert got["promotion"].quarantined == {"bad_date": 1}
    assert [str(r["end_date"]) for r in house.table("promotion").collect()] == ["2025-01-29"]
    assert got["channel"].missing == ("channel_name",) and house.table("channel").count() == 0
    (aside,) = house.quarantine("promotion").collect()
    assert (aside["start_date"], aside["_reason"]) == ("soon", "bad_date")
    (aside,) = house.quarantine("price_change").filter("_reason = 'bad_value'").collect()
    assert "dear" in aside["_corrupt_record"]


def test_a_second_run_adds_nothing_and_a_later_batch_only_what_is_new(spark, tmp_path, batch):
    house = Warehouse(spark, str(tmp_path / "house"))
    house.ingest(str(batch), NAMES)
    again = house.ingest(str(batch), NAMES)
    assert sum(x.inserted for x in again) == 0
    assert {x.table: x.present for x in again} == {"category": 2, "promotion": 1, "product": 2, "price_change": 1, "channel": 0}
    assert house.quarantine("product").count() == 1
    later = tmp_path / "two"
    put(later, "category", "category_id,category_name\nC9,Late\nC1,Renamed\n")
    put(later, "product", "product_id,category_id,brand,sku_name\nP2,C9,A,Found\n")
    got = {x.table: x for x in house.ingest(str(later), ["category", "product", "store"])}
    assert got["category"].inserted == 1 and got["category"].present == 1 and got["product"].inserted == 1
    assert got["store"].missing == tuple(TABLES["store"].schema.names)
    # What is there stays as it is.
    assert {r["category_id"]: r["category_name"] for r in house.table("category").collect()} == {"C1": "Snacks", "C2": "Soap", "C9": "Late"}


def test_nothing_is_seen_of_a_batch_that_fails(spark, tmp_path, batch, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "house"))
    house.ingest(str(batch), ["category"])
    monkeypatch.setattr(Warehouse, "_batches", lambda self, folder: (_ for _ in ()).throw(OSError("gone")) if "product" in folder else real(self, folder))
    with pytest.raises(OSError):
        house.ingest(str(batch), ["product"])
    monkeypatch.undo()
    assert house.table("product").count() == 0 and house.table("category").count() == 2
    assert house.ingest(str(batch), ["product"])[0].inserted == 2


real = Warehouse._batches


def test_report_rows(spark, tmp_path, batch):
    loaded = Warehouse(spark, str(tmp_path / "house")).ingest(str(batch), NAMES)
    rows = {(r["table_name"], r["outcome"]): r["n_rows"] for r in report(spark, loaded).collect()}
    assert rows["category", "inserted"] == 2 and rows["product", "orphan:category_id"] == 1
    assert rows["channel", "missing:channel_name"] == 0


def test_tables_run_side_by_side_but_after_their_parents(spark, tmp_path, monkeypatch):
    seen, meet = [], threading.Barrier(2, timeout=20)

    def merge(self, spec, path):
        if spec.name in ("category", "channel"):
            meet.wait()  # breaks if one runs after the other
        seen.append(spec.name)
        return spec.name

    monkeypatch.setattr(Warehouse, "_merge", merge)
    names = ["category", "channel", "product", "price_change"]
    assert Warehouse(spark, str(tmp_path / "house")).ingest(str(tmp_path), reversed(names)) == names
    assert seen[2:] == ["product", "price_change"]


def test_a_batch_without_new_keys_stages_its_rows_once_and_commits_nothing(spark, tmp_path, batch, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "house"))
    assert "LocalTableScan" in house.table("category")._jdf.queryExecution().executedPlan().toString()
    house.ingest(str(batch), ["category", "product"])
    commits, staged = [], len(staging._STAGED)
    commit = Warehouse._commit
    monkeypatch.setattr(Warehouse, "_commit", lambda self, rows, folder: (commits.append(folder), commit(self, rows, folder))[1])
    again = house.ingest(str(batch), ["category", "product"])
    assert [(x.inserted, x.present, x.duplicate) for x in again] == [(0, 2, 1), (0, 2, 0)]
    assert len(staging._STAGED) - staged == 2 and all("_quarantine" in c for c in commits)


def test_keys_are_sorted_where_their_hash_table_is_large_though_their_files_are_small(spark, tmp_path, monkeypatch):
    # 20,000 categories: some 50 KB of key by the size of the file, 2 MB as a hash table on the driver.
    folder = tmp_path / "one"
    put(folder, "category", "category_id,category_name\n" + "".join(f"C{i},Same\n" for i in range(20_000)))
    put(folder, "channel", "channel_id,channel_name\nW,web\n")
    lines = "".join(f"P{i},C{i},A,Same\n" for i in range(100)) + "".join(f"Q{i},X{i},A,Same\n" for i in range(5_000))
    put(folder, "product", "product_id,category_id,brand,sku_name\n" + lines)
    joined, join = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda self, *a, **k: (joined.append(join(self, *a, **k)), joined[-1])[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "600KB")
    try:
        house = Warehouse(spark, str(tmp_path / "house"))
        for run in (1, 2):
            got = {x.table: x for x in house.ingest(str(folder), ["category", "channel", "product"])}
            assert (got["product"].inserted, got["product"].present) == ((100, 0) if run == 1 else (0, 100))
            assert got["product"].quarantined == {"orphan:category_id": 5_000}
        assert house.quarantine("product").count() == 5_000 and house.table("category").count() == 20_000
        plans = [j._jdf.queryExecution().executedPlan().toString() for j in joined]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Parents of products (twice), loaded categories, rejected products; channels and loaded products are small.
    assert sum("SortMergeJoin" in p for p in plans) == 4 and sum("BroadcastHashJoin" in p for p in plans) == 2
