from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from halala.plans.staging import stg_ledger_transactions
from halala.schemas import DOCUMENT_FEEDS, LEDGER_FILE_COLUMNS, LEDGER_KEPT_COLUMNS
from halala.sources.landing import document_files, ledger_files, sample_documents
from halala.sources.warehouse import RAW, Warehouse, create_raw_tables, layer_name
from halala.streaming import load_once
from halala.streaming.load_once import landed_files, load_feed, load_history, load_listed, load_manifest, loads, merge_log, raw_rows
from tests.fixtures import DAY0, fx, ledger_row, write_ledger, write_text


@pytest.fixture
def feed(spark, tmp_path):
    """Loads a landing folder and returns its RAW rows."""

    def load(kind, folder):
        target, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
        load_feed(spark, kind, str(tmp_path / folder), target, checkpoint)
        return raw_rows(spark, target)

    return load


def test_ledger_files_load_once(feed, tmp_path, rows):
    folder = f"{tmp_path}/internal_ledger"
    write_ledger(f"{folder}/20260302T090000.csv", [ledger_row(n, DAY0) for n in range(3)])
    assert feed(ledger_files, "internal_ledger").count() == 3
    assert feed(ledger_files, "internal_ledger").count() == 3

    # a second file is added; the first is delivered again with other rows and stays as it was
    write_ledger(f"{folder}/20260303T090000.csv", [ledger_row(n, DAY0) for n in range(10, 15)])
    write_ledger(f"{folder}/20260302T090000.csv", [ledger_row(n, DAY0) for n in range(50, 60)])
    raw = feed(ledger_files, "internal_ledger")
    assert raw.columns == [*LEDGER_KEPT_COLUMNS, "batch_id", "file_name", "_loaded_at"]
    history = load_history(raw, "ledger_transactions_raw", "_loaded_at")
    assert rows(history, "table_name", "file_name", "row_count") == [
        ("ledger_transactions_raw", "internal_ledger/20260302T090000.csv", 3),
        ("ledger_transactions_raw", "internal_ledger/20260303T090000.csv", 5),
    ]
    assert rows(raw.select("batch_id").distinct()) == [("20260302T090000",), ("20260303T090000",)]


def test_old_modification_time_is_no_reason_to_skip(feed, tmp_path):
    import os

    folder = f"{tmp_path}/internal_ledger"
    write_ledger(f"{folder}/new.csv", [ledger_row(1, DAY0)])
    assert feed(ledger_files, "internal_ledger").count() == 1
    write_ledger(f"{folder}/late.csv", [ledger_row(2, DAY0)])
    old = dt.datetime(2020, 1, 1).timestamp()
    os.utime(f"{folder}/late.csv", (old, old))
    assert feed(ledger_files, "internal_ledger").count() == 2


def test_quoted_values(spark, tmp_path, rows):
    name = 'Al "the fox", Ltd\\'
    write_ledger(f"{tmp_path}/a.csv", [ledger_row(1, DAY0, client_name=name), ledger_row(2, DAY0, portfolio_id="")])
    raw = ledger_files(spark.read, str(tmp_path))
    assert rows(raw, "client_name") == [('Al "the fox", Ltd\\',), ("Holder no. 2",)]
    assert rows(raw.where("portfolio_id is null"), "client_id") == [("H-02",)]


@pytest.mark.parametrize(
    "columns",
    [
        LEDGER_FILE_COLUMNS[:-1],
        LEDGER_FILE_COLUMNS[::-1],
        [*LEDGER_FILE_COLUMNS[:6], "price", "quantity", *LEDGER_FILE_COLUMNS[8:]],
    ],
)
def test_wrong_header_fails_the_load(spark, tmp_path, columns):
    write_ledger(f"{tmp_path}/a.csv", [ledger_row(1, DAY0)], columns)
    with pytest.raises(Exception, match="(?i)header|malformed|schema"):
        ledger_files(spark.read, str(tmp_path)).collect()


def test_short_line_fails_the_load(spark, tmp_path):
    write_text(f"{tmp_path}/a.csv", ",".join(LEDGER_FILE_COLUMNS) + "\nT1,C001\n")
    with pytest.raises(Exception, match="MALFORMED"):
        ledger_files(spark.read, str(tmp_path)).collect()


def test_a_bad_value_does_not_block_the_load(spark, tmp_path):
    write_ledger(f"{tmp_path}/a.csv", [ledger_row(1, DAY0, quantity="lots")])
    staged = stg_ledger_transactions(ledger_files(spark.read, str(tmp_path)))
    assert staged.first()["quantity"] is None


def test_documents_load_once(feed, tmp_path, rows):
    folder = f"{tmp_path}/exchange_rates"
    pretty = json.dumps(json.loads(fx(DAY0, {"SAR": 3.75})), indent=2)
    write_text(f"{folder}/2026-03-02.json", pretty)
    write_text(f"{folder}/notes.txt", "not a document")
    feed(document_files, "exchange_rates")
    write_text(f"{folder}/2026-03-03.json", fx(DAY0, {"SAR": 3.76}))
    raw = feed(document_files, "exchange_rates")
    assert rows(raw, "file_name") == [("exchange_rates/2026-03-02.json",), ("exchange_rates/2026-03-03.json",)]
    assert raw.where("file_name like '%02.json'").first()["raw"] == pretty


@pytest.mark.parametrize("text", ['{"success": tru', "[1, 2]", '{"a": 1} {"b": 2}', "  "])
def test_malformed_document_fails_the_load(feed, tmp_path, spark, text):
    write_text(f"{tmp_path}/exchange_rates/a.json", fx(DAY0, {"SAR": 3.75}))
    write_text(f"{tmp_path}/exchange_rates/b.json", text)
    with pytest.raises(Exception):
        feed(document_files, "exchange_rates")
    # nothing of the batch was committed
    stored = raw_rows(spark, str(tmp_path / "raw"))
    assert stored is None or stored.count() == 0


def test_listed_files_load_once(spark, tmp_path, rows):
    paths = [f"{tmp_path}/internal_ledger/{n}.csv" for n in "abc"]
    for n, path in enumerate(paths):
        write_ledger(path, [ledger_row(n * 10 + i, DAY0) for i in range(n + 1)])
    target = f"{tmp_path}/raw"
    assert load_listed(spark, ledger_files, paths[:2], target) == paths[:2]
    assert load_listed(spark, ledger_files, paths, target) == paths[2:]
    assert load_listed(spark, ledger_files, paths, target) == []
    history = load_history(raw_rows(spark, target), "t", "_loaded_at")
    assert rows(history, "file_name", "row_count") == [(f"internal_ledger/{n}.csv", i + 1) for i, n in enumerate("abc")]


def test_stream_and_list_share_a_table(spark, tmp_path, rows):
    """Neither form hides or repeats what the other has loaded, whatever the order and checkpoint."""
    folder, target = f"{tmp_path}/internal_ledger", f"{tmp_path}/raw"
    write_ledger(f"{folder}/a.csv", [ledger_row(n, DAY0) for n in range(2)])
    load_feed(spark, ledger_files, folder, target, f"{tmp_path}/c1")
    write_ledger(f"{folder}/b.csv", [ledger_row(n, DAY0) for n in range(3)])
    paths = [f"{folder}/a.csv", f"{folder}/b.csv"]
    assert load_listed(spark, ledger_files, paths, target) == paths[1:]
    assert load_listed(spark, ledger_files, paths, target) == []
    write_ledger(f"{folder}/c.csv", [ledger_row(9, DAY0)])
    load_feed(spark, ledger_files, folder, target, f"{tmp_path}/c1")
    load_feed(spark, ledger_files, folder, target, f"{tmp_path}/c2")
    history = load_history(raw_rows(spark, target), "t", "_loaded_at")
    assert rows(history, "file_name", "row_count") == [(f"internal_ledger/{n}.csv", c) for n, c in (("a", 2), ("b", 3), ("c", 1))]


def test_a_batch_without_its_log_rows_is_not_there(spark, tmp_path, rows):
    """As if the run had died between the rows and the log: nobody sees the rows, and the batch is repeated."""
    folder, target = f"{tmp_path}/internal_ledger", f"{tmp_path}/raw"
    write_ledger(f"{folder}/a.csv", [ledger_row(1, DAY0)])
    load_feed(spark, ledger_files, folder, target, f"{tmp_path}/c")
    half = raw_rows(spark, target).withColumn("file_name", F.lit("internal_ledger/b.csv"))
    half.write.parquet(f"{target}/load_batch=died")
    assert raw_rows(spark, target).count() == 1
    write_ledger(f"{folder}/b.csv", [ledger_row(2, DAY0), ledger_row(3, DAY0)])
    load_feed(spark, ledger_files, folder, target, f"{tmp_path}/c")
    assert rows(loads(spark, target), "file_name", "row_count") == [("internal_ledger/a.csv", 1), ("internal_ledger/b.csv", 2)]
    assert raw_rows(spark, target).count() == 3


def test_the_log_is_merged(spark, tmp_path, rows):
    folder, target = f"{tmp_path}/internal_ledger", f"{tmp_path}/raw"
    for n in range(4):
        write_ledger(f"{folder}/{n}.csv", [ledger_row(n, DAY0)])
        load_listed(spark, ledger_files, [f"{folder}/{n}.csv"], target)
    before = rows(loads(spark, target))
    assert len(before) == 4 and not merge_log(spark, target, 4) and merge_log(spark, target, 3)
    assert rows(loads(spark, target)) == before and raw_rows(spark, target).count() == 4
    assert len([p for p in (tmp_path / "raw.loads").iterdir() if p.name.startswith("slot=")]) == 1


def test_an_older_table_gets_its_log(spark, tmp_path, rows):
    folder, target = f"{tmp_path}/internal_ledger", f"{tmp_path}/raw"
    write_ledger(f"{folder}/a.csv", [ledger_row(1, DAY0), ledger_row(2, DAY0)])
    ledger_files(spark.read, folder).write.parquet(f"{target}/load_batch=old")
    load_feed(spark, ledger_files, folder, target, f"{tmp_path}/c")
    assert raw_rows(spark, target).count() == 2
    assert rows(loads(spark, target), "batch", "row_count") == [("old", 2)]


def test_a_manifest_of_many_files_is_read_by_folder(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(load_once, "FEW", 1)
    for n in range(5):
        write_ledger(f"{tmp_path}/internal_ledger/{n}.csv", [ledger_row(n, DAY0)])
    files = landed_files(spark, f"{tmp_path}/internal_ledger", "*.csv").where("file_name not like '%4.csv'")
    assert load_manifest(spark, ledger_files, files, f"{tmp_path}/raw").count() == 4
    assert load_manifest(spark, ledger_files, files, f"{tmp_path}/raw").count() == 0
    assert raw_rows(spark, f"{tmp_path}/raw").count() == 4


def test_a_refused_batch_leaves_the_table_as_it_was(spark, tmp_path):
    folder, target = f"{tmp_path}/internal_ledger", f"{tmp_path}/raw"
    write_ledger(f"{folder}/a.csv", [ledger_row(1, DAY0)])

    def check(batch):
        if batch.where("client_id = 'H-03'").count():
            raise ValueError("no such client")

    load_feed(spark, ledger_files, folder, target, f"{tmp_path}/c", check=check)
    write_ledger(f"{folder}/b.csv", [ledger_row(3, DAY0)])
    for _ in range(2):
        with pytest.raises(ValueError, match="no such client"):
            load_feed(spark, ledger_files, folder, target, f"{tmp_path}/c", check=check)
        assert raw_rows(spark, target).count() == 1


def test_sample_replay_is_in_name_order(spark, tmp_path):
    for name in ["b", "a", "c"]:
        write_text(f"{tmp_path}/s/{name}.json", "{}")
    found = [r.file_name for r in sample_documents(spark, f"{tmp_path}/s").collect()]
    assert found == ["s/a.json", "s/b.json", "s/c.json"]
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        sample_documents(spark, f"{tmp_path}/empty")


def test_raw_tables_are_created_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    create_raw_tables(warehouse)
    table = next(iter(DOCUMENT_FEEDS.values()))
    assert warehouse.read(RAW, table).count() == 0
    spark.createDataFrame([("{}", "a.json", dt.datetime(2026, 1, 1))], warehouse.read(RAW, table).schema).write.parquet(
        f"{warehouse.path(RAW, table)}/load_batch=one"
    )
    create_raw_tables(warehouse)
    assert warehouse.read(RAW, table).count() == 1


def test_layer_names_are_kept():
    assert layer_name(" staging ") == "staging"
    assert layer_name(None) == "main"
