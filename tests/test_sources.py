import datetime as dt

import pytest
from conftest import RUN_DATE, rows
from pyspark.sql import functions as F

from rosterkeep.functions.typing import too_long
from rosterkeep.model import IDENTITY, ITEMS, MEMBERS
from rosterkeep.plans.bindings import in_layout
from rosterkeep.sources import directory, paths, reports, templates
from rosterkeep.sources.store import NoTable, Store, typed_scan


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_csv_text(spark, tmp_path):
    path = write(tmp_path / "r.csv", 'Title,Owner,Tags,Extra\n"two\nlines","say ""hi""","",x\n  padded ,NA,,\nNull,"a,b",\\,"\\""t"\n')
    got = rows(reports.read_text_columns(spark, path, ITEMS))
    assert got == [("  padded ", "NA", None, None), ("Null", "a,b", "\\", '\\"t'), ("two\nlines", 'say "hi"', None, "x")]


def test_files_are_split_where_rows_end_in_crlf(spark, tmp_path):
    texts = ["two\nlines", 'say "hi"\n', "plain", "a,b", "\n"]
    lines = ["Username,Name"] + [f'u{i},"{texts[i % 5].replace(chr(34), chr(34) * 2)}"' for i in range(5000)]
    path = write(tmp_path / "r.csv", "\r\n".join(lines) + "\r\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = reports.read_text_columns(spark, path, MEMBERS, line_sep="\r\n")
        assert df.rdd.getNumPartitions() > 4
        assert dict(tuple(r) for r in df.collect()) == {f"u{i}": texts[i % 5] for i in range(5000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_report_is_bound_by_header_and_typed(spark, tmp_path):
    path = write(
        tmp_path / "m.csv",
        "Verified Email Status,Username,Available Credits,Last Login Date,# of Items Owned,Unknown\n"
        'No,u,"1,000",5/14/2026 1:02:03 PM,3,z\nyes,v,12.5,2026-05-14,x,\n,w,,never,,\n',
    )
    df = reports.read_report(spark, path, MEMBERS, RUN_DATE, note_unreadable=True)
    assert dict(df.dtypes)["last_login_date"] == "timestamp_ntz" and dict(df.dtypes)["items_owned"] == "double"
    assert rows(df, "username", "verified_email_status", "available_credits", "last_login_date", "items_owned", "Unknown", "updated_date") == [
        ("u", False, None, dt.datetime(2026, 5, 14, 13, 2, 3), 3.0, "z", RUN_DATE),
        ("v", True, 12.5, dt.datetime(2026, 5, 14), None, None, RUN_DATE),
        ("w", None, None, None, None, None, RUN_DATE),
    ]
    assert rows(df.where(F.size("unreadable") > 0), "username", "unreadable") == [
        ("u", ["available_credits: 1,000"]), ("v", ["items_owned: x"]), ("w", ["last_login_date: never"]),
    ]


def test_na_tokens_are_an_option(spark, tmp_path):
    path = write(tmp_path / "m.csv", "Username,Name\nNA,Null\n")
    assert rows(reports.read_report(spark, path, MEMBERS, RUN_DATE), "username", "name") == [("NA", "Null")]
    assert rows(reports.read_report(spark, path, MEMBERS, RUN_DATE, na_tokens=["NA"]), "username", "name") == [(None, "Null")]


def test_csv_round_trip_keeps_order_and_text(spark, tmp_path):
    texts = ['a "quoted" word', "line\nfeed", " blanks ", "back\\slash\\", "comma, here", "ünï", '"', "\r\n", "z"]
    df = spark.createDataFrame([(f"{i:03d}", t) for i, t in enumerate(texts * 20)], "username string, name string").orderBy(F.desc("username"))
    path = reports.write_csv(df, str(tmp_path / "out"), MEMBERS)
    back = reports.read_text_columns(spark, path)
    assert back.columns == ["Username", "Name"]
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_latest_report_of_each_kind(spark, tmp_path):
    import os

    for age, title in ((3, "OrganizationItems_a"), (1, "OrganizationItems_b"), (2, "OrganizationMembers_a"), (0, "Other_c")):
        path = write(tmp_path / "in" / f"{title}.csv", "x\n1\n")
        os.utime(path, (1_700_000_000 - age * 1000,) * 2)
    found = reports.manifest(spark, str(tmp_path / "in"))
    chosen = reports.latest_report_paths(found, ["items", "members"])
    assert chosen["items"].endswith("OrganizationItems_b.csv") and chosen["members"].endswith("OrganizationMembers_a.csv")
    assert rows(reports.with_names(found).where("kind is null"), "table_name") == [("Other_c",)]
    with pytest.raises(reports.NoReport):
        reports.latest_report_paths(found, ["items", "identity"])


def test_newest_dated_path(spark, tmp_path):
    for day in ("2026_05_15", "2026_12_30", "2026_06_15"):
        write(tmp_path / f"UsersOverQuota_{day}" / "part.csv", "x\n")
    assert reports.newest_dated_path(spark, str(tmp_path), "UsersOverQuota").endswith("UsersOverQuota_2026_12_30")
    with pytest.raises(reports.NoReport):
        reports.newest_dated_path(spark, str(tmp_path), "Nothing")


def test_snapshots(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(NoTable):
        store.snapshot("items")
    for day, name in ((1, "a"), (3, "c"), (2, "b")):
        store.write_snapshot("identity", dt.date(2026, 1, day), in_layout(spark.createDataFrame([(name,)], "username string"), IDENTITY))
    assert rows(store.snapshot("identity"), "username") == [("c",)]
    assert rows(store.snapshot("identity", dt.date(2026, 1, 2)), "username") == [("b",)]
    store.mark_folded("identity", [dt.date(2026, 1, 1)])
    assert store.pending_dates("identity") == [dt.date(2026, 1, 2), dt.date(2026, 1, 3)]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace("t", spark.range(3))
    store.replace("t", store.read("t").where("id > 0"))
    assert store.read("t").count() == 2
    write(tmp_path / "tables" / "t" / "version=000003" / "part-x.parquet", "broken")
    assert store.read("t").count() == 2
    store.replace("t", store.read("t").where("id > 1"))
    assert store.current_version("t") == 3 and store.read("t").count() == 1


def test_history_store(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.history("identity").count() == 0

    def day(k, *names):
        df = in_layout(spark.createDataFrame([(n, dt.date(2026, 1, k)) for n in names], "username string, updated_date date"), IDENTITY)
        from rosterkeep.operators import history

        store.add_fold("identity", history.fold_open(store.open_states("identity"), [df], IDENTITY))

    def seen():
        return [(n, d.day) for n, d in rows(store.history("identity"), "username", "updated_date")]

    day(1, "a", "b")
    day(2, "b", "c")
    assert seen() == [("a", 1), ("b", 2), ("c", 2)] and rows(store.open_states("identity"), "username") == [("b",), ("c",)]
    store.compact_history("identity")
    assert seen() == [("a", 1), ("b", 2), ("c", 2)] and rows(store.open_states("identity"), "username") == [("b",), ("c",)]
    day(3, "a", "c")
    day(4, "a")
    assert seen() == [("a", 4), ("b", 2), ("c", 3)]
    day(4, "a")
    assert seen() == [("a", 4), ("b", 2), ("c", 3)]
    store.compact_history("identity")
    assert seen() == [("a", 4), ("b", 2), ("c", 3)]


def test_typed_scan_reads_by_name(spark, tmp_path):
    spark.createDataFrame([("x", "u")], "other string, username string").write.parquet(str(tmp_path / "p"))
    assert rows(typed_scan(spark, str(tmp_path / "p"), "identity", ["username", "groups"])) == [("u", None)]


def test_directory_exports(spark, tmp_path):
    path = write(tmp_path / "users.json", '{"listing_pos": 1, "id": "1", "other_mails": ["a", "b"], "unknown": 2}\n')
    assert rows(directory.read_directory(spark, path), "id", "other_mails", "mail") == [("1", ["a", "b"], None)]
    path = write(tmp_path / "groups.json", '{"id": "g", "name": "n"}\n')
    assert rows(directory.read_whitelist(spark, path)) == [("g",)]


def test_templates(spark, tmp_path):
    for kind in ("delete", "flag", "quota"):
        write(tmp_path / f"{kind}.txt", f"Dear {{recipient_name}},\n\n{kind}\n")
    got = templates.read_templates(spark, str(tmp_path))
    assert got["flag"].body == "Dear {recipient_name},\n\nflag\n" and got["quota"].subject == templates.SUBJECTS["quota"]


def test_too_long(spark):
    df = spark.createDataFrame([("x" * 256, "y", 3), (None, "y" * 255, 4)], "a string, b string, c int")
    assert rows(df.select("c", too_long(df).alias("n"))) == [(3, 1), (4, 0)]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert paths.shared_folder(spark) == named.rstrip("/") and paths.scratch(spark, "x").startswith(f"{named.rstrip('/')}/x-")


def test_files_of_a_report_are_bound_by_their_own_headers(spark, tmp_path):
    import gzip

    write(tmp_path / "r" / "part-0.csv", "Username,Email\na,a@x\n")
    write(tmp_path / "r" / "part-1.csv", "Email,Username,Name\r\nb@x,b,Bob\r\n")
    write(tmp_path / "r" / "part-2.csv", "")
    (tmp_path / "r" / "part-3.csv.gz").write_bytes(gzip.compress(b"Email,Username\nc@x,c\n"))
    got = reports.read_text_columns(spark, str(tmp_path / "r"), MEMBERS)
    assert rows(got, "username", "email", "name") == [("a", "a@x", None), ("b", "b@x", "Bob"), ("c", "c@x", None)]


def test_unfinished_reports_are_not_read(spark, tmp_path):
    write(tmp_path / "UsersOverQuota_2026_05_15" / "part.csv", "x\n")
    write(tmp_path / "UsersOverQuota_2026_06_15" / "_temporary" / "0" / "part.csv", "x\n")
    (tmp_path / "UsersOverQuota_2026_07_15").mkdir()
    assert reports.newest_dated_path(spark, str(tmp_path), "UsersOverQuota").endswith("2026_05_15")
    assert rows(reports.manifest(spark, str(tmp_path)), "title") == [("UsersOverQuota_2026_05_15",)]
