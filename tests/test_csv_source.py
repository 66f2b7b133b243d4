"""CSV scan with differing headers, quoting, Latin-1, NA tokens."""

import os

import pytest

from folio.sources.catalog_csv import ingest, read_catalog_csv


def write(path, name, text):
    with open(os.path.join(path, name), "wb") as f:
        f.write(text.encode("latin-1"))


@pytest.fixture()
def csv_dir(tmp_dir):
    d = os.path.join(tmp_dir, "raw")
    os.makedirs(d)
    write(d, "a.csv",
          'Title,ISBN,Year,Author/Editor\n'
          '"A ""quoted"" t\xe9",978-0,1999,Ann\n'
          '"two\nlines",,abc,NA\n'
          ' \xa0padded\t ,0-306-40615-2, 1999 ,None\n')
    write(d, "b.csv",
          'Year,Title,Extra\n'
          '2036,Later,x\n'
          'n.d.,nan,y\n')
    write(d, "notes.txt", "ignored")
    return d


def test_read_groups_by_header(spark, csv_dir):
    df = read_catalog_csv(spark, csv_dir)
    assert df.count() == 5
    assert {"Title", "ISBN", "Year", "Author/Editor", "Extra", "source_file", "row_pos"} <= set(df.columns)
    extra = {r["Title"]: r["Extra"] for r in df.collect()}
    assert extra["Later"] == "x" and extra['A "quoted" t\xe9'] is None


def test_ingest_canonical(spark, csv_dir):
    out = ingest(spark, csv_dir).orderBy("file_path", "row_pos").collect()
    titles = [r["title"] for r in out]
    assert titles == ['A "quoted" t\xe9', "two\nlines", " \xa0padded\t ", "Later", None]
    assert [r["year"] for r in out] == [1999.0, None, 1999.0, 2036.0, None]
    assert out[0]["isbn"] == "978-0" and out[1]["isbn"] is None and out[2]["isbn"] == "0-306-40615-2"
    assert out[1]["author_editor"] is None and out[2]["author_editor"] is None
    assert out[3]["accession_no"] is None and out[3]["Extra"] == "x"


def test_missing_dir_is_error(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_catalog_csv(spark, os.path.join(tmp_dir, "nope"))


def test_empty_dir_gives_empty_result(spark, tmp_dir):
    d = os.path.join(tmp_dir, "empty")
    os.makedirs(d)
    assert ingest(spark, d).count() == 0


def test_header_read_through_spark_matches(spark, csv_dir, monkeypatch):
    from folio.sources import catalog_csv

    files = catalog_csv.list_files(spark, csv_dir)
    want = {k: sorted(v) for k, v in catalog_csv.sniff_headers(spark, files).items()}

    def unknown(uri, encoding):
        raise ValueError("Unrecognized filesystem type in URI")

    monkeypatch.setattr(catalog_csv, "_read_header", unknown)
    assert {k: sorted(v) for k, v in catalog_csv.sniff_headers(spark, files).items()} == want

    def broken(uri, encoding):
        raise ValueError("disk error")

    monkeypatch.setattr(catalog_csv, "_read_header", broken)
    with pytest.raises(Exception, match="disk error"):
        catalog_csv.sniff_headers(spark, files)


def test_first_record_is_complete():
    from folio.sources.catalog_csv import first_record

    def chunks(data, size=7):
        return (data[i:i + size] for i in range(0, len(data), size))

    long = [f"column {i} " + "x" * 40 for i in range(30_000)]  # over a megabyte
    assert first_record(chunks(",".join(long).encode() + b"\n1,2", 65536), "ISO-8859-1") == long
    assert first_record(chunks(b'a,"two\r\nlines ""q""",c\r\n1,2,3'), "utf-8") == ["a", 'two\r\nlines "q"', "c"]
    assert first_record(chunks("é,b".encode("latin-1")), "ISO-8859-1") == ["é", "b"]
    assert first_record(chunks(b""), "utf-8") == []
