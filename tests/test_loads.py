from datetime import date, datetime
from decimal import Decimal

import pytest

from ledgerlake.operators.checks import rejected_rule
from ledgerlake.schemas import SOURCES, TABLES
from ledgerlake.sources import delimited
from ledgerlake.sources.delimited import load_source, read_text, rejected_cells, type_rows

DT = "2026-06-14"


def stage(path, header, *rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.csv").write_text("\n".join("\t".join(r) for r in (header, *rows)) + "\n", encoding="utf-8")
    return str(path)


LOAN = [f.name.upper() for f in SOURCES["loan"].schema]


def loan(**cells):
    return [cells.get(name.lower(), "") for name in LOAN]


def test_good_row(spark, tmp_path):
    path = stage(tmp_path / "l", LOAN, loan(
        contract_no="L1", customer_id="C1", loan_amt="1000.5", rate="0.0355", term="12", sign_date="2026-01-02"))
    row = load_source(spark, "loan", path, DT).first()
    assert (row.contract_no, row.loan_amt, row.rate, row.term, row.sign_date) == (
        "L1", Decimal("1000.50"), Decimal("0.035500"), 12, date(2026, 1, 2))
    assert (row.source_system, row.batch_id) == ("LOAN", "batch_20260614")
    assert isinstance(row.ingest_time, datetime)
    assert row.loan_type is None  # empty text is null


def test_bad_cells_turn_null_and_are_reported(spark, tmp_path):
    path = stage(
        tmp_path / "l", LOAN,
        loan(contract_no="ok", loan_amt="1", term="12.0", sign_date="2026-01-02"),
        loan(contract_no="bad", loan_amt="1,000", term="year", sign_date="2026-13-45"),
        loan(contract_no="blank"),
    )
    raw = read_text(spark, path)
    rows = {r.contract_no: r for r in type_rows(raw, "loan", DT).collect()}
    assert rows["ok"].term == 12
    assert (rows["bad"].loan_amt, rows["bad"].term, rows["bad"].sign_date) == (None, None, None)
    assert len(rows) == 3
    rejected = rejected_cells(raw, "loan").collect()
    assert [(r.CONTRACT_NO, r.rejected) for r in rejected] == [("bad", ["loan_amt", "term", "sign_date"])]
    assert tuple(rejected_rule(raw, "loan").first()) == ("rejected_cells", "loan", 1, 3)


def test_amount_beyond_the_type_is_rejected(spark, tmp_path):
    path = stage(tmp_path / "l", LOAN, loan(contract_no="big", loan_amt="1" + "0" * 17))
    assert rejected_cells(read_text(spark, path), "loan").first().rejected == ["loan_amt"]


def test_columns_go_by_name(spark, tmp_path):
    path = stage(
        tmp_path / "a", ["PRODUCT_ID", "EXTRA", *[c.upper() for c in
                         "branch_id status open_date currency acct_type customer_id account_no".split()]],
        ["P1", "x", "B1", "NORMAL", "2020-02-29", "CNY", "DEMAND", "C1", "A1"])
    row = load_source(spark, "account", path, DT).first()
    assert (row.account_no, row.customer_id, row.product_id, row.open_date) == ("A1", "C1", "P1", date(2020, 2, 29))


def test_close_date_is_always_null(spark, tmp_path):
    header = [f.name.upper() for f in SOURCES["customer"].schema]
    path = stage(tmp_path / "c", header, ["2020-01-01" if h == "CLOSE_DATE" else "C1" if h == "CUSTOMER_ID" else "" for h in header])
    raw = read_text(spark, path)
    assert type_rows(raw, "customer", DT).first().close_date is None
    assert rejected_cells(raw, "customer").count() == 0


@pytest.mark.parametrize("name", SOURCES)
def test_load_gives_the_table_schema(spark, tmp_path, name):
    path = stage(tmp_path / name, [f.name for f in SOURCES[name].schema], ["1"] * len(SOURCES[name].schema))
    df = load_source(spark, name, path, DT)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES[f"ods_{name}"].schema]


def test_times_keep_their_fraction(spark, tmp_path):
    header = [f.name for f in SOURCES["balance"].schema]
    path = stage(tmp_path / "b", header, ["A1", "1", "1", "0", "2026-06-14 23:59:48.123456"])
    assert load_source(spark, "balance", path, DT).first().last_update == datetime(2026, 6, 14, 23, 59, 48, 123456)


def test_columns_go_by_each_file_s_own_header(spark, tmp_path):
    names = SOURCES["account"].schema.names
    for file, order in (("a", names), ("b", names[::-1])):
        rows = [{n: f"{file}-{n}" for n in names}, {n: "" for n in names}]
        lines = ["\t".join(order), *("\t".join(r[n] for n in order) for r in rows)]
        (tmp_path / f"{file}.tsv").write_text("\n".join(lines) + "\n")
    raw = delimited.read_text(spark, str(tmp_path))
    got = {r.account_no: r.customer_id for r in delimited.type_rows(raw, "account", "2026-06-14").collect()}
    assert got["a-account_no"] == "a-customer_id" and got["b-account_no"] == "b-customer_id"


def test_short_and_long_lines_are_set_aside(spark, tmp_path):
    names = SOURCES["account"].schema.names
    good = ["A1", *[""] * (len(names) - 1)]
    lines = ["\t".join(names), "\t".join(good), "A2\tC2", "\t".join(["A3", *good])]
    (tmp_path / "x.tsv").write_text("\n".join(lines) + "\n")
    raw = delimited.read_text(spark, str(tmp_path))
    with pytest.raises(Exception, match="too few or too many cells"):
        delimited.type_rows(raw, "account", "2026-06-14").collect()
    load, aside = delimited.split_rejects(delimited.with_rejects(raw, "account"))
    assert [r.account_no for r in delimited.type_rows(load, "account", "2026-06-14").collect()] == ["A1"]
    assert sorted(r[delimited.BAD_LINE] for r in aside.collect()) == sorted(lines[2:])
    assert {tuple(r.rejected) for r in aside.collect()} == {(delimited.BAD_LINE,)}


def test_headers_of_many_files_are_found_by_tasks(spark, tmp_path, monkeypatch):
    names = SOURCES["account"].schema.names
    folder = tmp_path / "many files, named oddly"
    folder.mkdir()
    for k in range(300):
        order = names if k % 3 else names[::-1]
        lines = ["\t".join(order), "\t".join(f"{k}-{n}" for n in order), ""] if k % 10 else ["\ufeff" + "\t".join(order)]
        (folder / f"p{k:03d} a.tsv").write_text("\n".join(lines))
    (folder / "empty.tsv").write_text("")
    (folder / "_hidden.tsv").write_text("x\ty\n1\t2\n")
    opened = []
    monkeypatch.setattr(type(spark._jvm.org.apache.hadoop.fs.Path("/")), "__call__", lambda *a: opened.append(a), raising=False)
    found = delimited._headers(spark, [str(folder)])
    assert len(found) == 2 and sum(map(len, found.values())) == 300 and not opened
    rows = type_rows(read_text(spark, str(folder)), "account", DT).collect()
    assert sorted(r.account_no for r in rows) == sorted(f"{k}-account_no" for k in range(300) if k % 10)
    assert all(r.customer_id == r.account_no.replace("account_no", "customer_id") for r in rows)


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_text(spark, str(tmp_path / "nothing"))
