"""Delimited feeds under contracts: reader options and hostile rows."""

import os

import pytest

from loadkit.contracts import ColumnMap, ContractError, FeedContract, validate_mapping
from loadkit.sources.delimited import CORRUPT, SOURCE_FILE, file_outcomes, load_delimited


def write(path, text):
    with open(path, "w", newline="") as fh:
        fh.write(text)
    return path


def contract(cols, **kw):
    return FeedContract(name="t", columns=tuple(ColumnMap(s, t, ty) for s, t, ty in cols), **kw)


PIPE = contract([("_c0", "rec_type", "string"), ("_c1", "area", "string"), ("_c2", "code", "string"),
                 ("_c3", "valid_to", "string"), ("_c4", "created", "date")],
                sep="|", quote='"', multiline=True, date_format="yyyyMMdd")


def test_pipe_dates_and_hostile_cells(spark, tmp):
    p = write(os.path.join(tmp, "a.txt"),
              'H|A1|C1|99991231|20230115\n'
              'H|A2|C2|x|\n'            # blank date
              'H|A3|C3|x|00000000\n'    # all-zero date
              'H|A4|C4|x|20230230\n'    # impossible date
              'H|"A|5"|C5|x|20230101\n'  # quoted separator
              'H|"A\n6"|C6|x|20230102\n'  # quoted newline
              'H|"A""7"|C7|x|20230103\n')  # doubled quote
    rows = {r["code"]: r for r in load_delimited(spark, p, PIPE).collect()}
    assert str(rows["C1"]["created"]) == "2023-01-15"
    assert rows["C2"]["created"] is None and rows["C3"]["created"] is None and rows["C4"]["created"] is None
    assert rows["C5"]["area"] == "A|5"
    assert rows["C6"]["area"] == "A\n6"
    # no EscapeChar in the contract: a doubled quote is not an escape (Spark's default
    # escape is backslash), so the cell keeps its raw text; contracts with escape '"' unescape it
    assert rows["C7"]["area"] == '"A""7"'
    assert list(load_delimited(spark, p, PIPE).columns) == ["rec_type", "area", "code", "valid_to", "created"]


def test_field_count_errors_are_counted_per_file(spark, tmp):
    d = os.path.join(tmp, "feed")
    os.makedirs(d)
    write(os.path.join(d, "good.txt"), "H|A|C1|x|20230101\n")
    write(os.path.join(d, "bad.txt"), "H|A|C2\nH|A|C3|x|20230101|extra\n")
    df = load_delimited(spark, d, PIPE, with_source_file=True, with_rejects=True)
    out = {os.path.basename(r[SOURCE_FILE]): r["n_rejects"] for r in file_outcomes(df).collect()}
    assert out["good.txt"] == 0
    assert out["bad.txt"] == 2
    short = df.filter("code = 'C2'").first()
    assert short["valid_to"] is None and short[CORRUPT] is not None


AMOUNTS = contract([("_c0", "company", "string"), ("_c1", "doc_no", "string"), ("_c2", "invoice_date", "date"),
                    ("_c3", "amount", "decimal(15,2)"), ("_c4", "qty", "decimal(15,3)")],
                   sep=",", quote='"', escape='"', trim_leading=True, date_format="yyyyMMdd")


def test_amounts_precision_and_trim(spark, tmp):
    p = write(os.path.join(tmp, "b.csv"),
              '  C1,D1,20230105,1234.56,1.5\n'
              'C2,D2,20230105,abc,2\n'                 # non-numeric
              'C3,D3,20230105,12345678901234.50,3\n'   # over precision
              'C4,"D ""4""",20230105,1,4\n')           # quote escaped by quote
    rows = {r["doc_no"]: r for r in load_delimited(spark, p, AMOUNTS).collect()}
    assert rows["D1"]["company"] == "C1"
    assert str(rows["D1"]["amount"]) == "1234.56" and str(rows["D1"]["qty"]) == "1.500"
    assert rows["D2"]["amount"] is None
    assert rows["D3"]["amount"] is None
    assert 'D "4"' in rows


TAB = contract([("company_code", "company_code", "string"), ("vendor", "vendor", "string"),
                ("post_date", "post_date", "date"), ("doc_amount", "doc_amount", "decimal(15,2)")],
               header=True, sep="\t", date_format="MM/dd/yyyy")


def test_tab_header_feed(spark, tmp):
    p = write(os.path.join(tmp, "c.tsv"), "company_code\tvendor\tpost_date\tdoc_amount\nX\tV1\t01/31/2023\t10.00\n")
    r = load_delimited(spark, p, TAB).first()
    assert str(r["post_date"]) == "2023-01-31" and str(r["doc_amount"]) == "10.00"


def test_header_only_and_empty_files(spark, tmp):
    d = os.path.join(tmp, "hdr")
    os.makedirs(d)
    write(os.path.join(d, "h.tsv"), "company_code\tvendor\tpost_date\tdoc_amount\n")
    write(os.path.join(d, "e.tsv"), "")
    assert load_delimited(spark, d, TAB).count() == 0


def test_header_names_must_match(spark, tmp):
    p = write(os.path.join(tmp, "d.tsv"), "cc\tvend\tdt\tamt\nX\tV1\t01/31/2023\t10.00\n")
    with pytest.raises(Exception):
        load_delimited(spark, p, TAB).collect()


def test_wide_feed_generated(spark, tmp):
    cols = [(f"_c{i}", f"col_{i}", "date" if i % 9 == 0 else "string") for i in range(120)]
    c = contract(cols, sep="|", date_format="yyyyMMdd")
    line = "|".join("20230101" if i % 9 == 0 else f"v{i}" for i in range(120))
    p = write(os.path.join(tmp, "w.txt"), line + "\n")
    r = load_delimited(spark, p, c).first()
    assert len(r) == 120 and str(r["col_9"]) == "2023-01-01" and r["col_119"] == "v119"


def test_mapping_json_and_validation():
    m = {"MappingName": "m", "SourceFileName": "f.txt", "SourceSystemID": "sys", "SourceFileID": "F",
         "SourceFilePattern": "F*.txt", "SourceFileType": "csv", "SourceExtractType": "full",
         "HasHeaderRecord": "no", "RecordDelimiter": "|", "TargetTableName": "t", "TargetDatabaseName": "raw",
         "TargetLoadType": "overwrite", "LoadAllIncrementalFiles": "no", "LoadLatestFile": "yes",
         "TextQualifier": '"', "Multiline": "yes", "EscapeChar": "", "DateFormat": "yyyyMMdd",
         "TimestampFormat": None,
         "SourceToTargetMapping": [
             {"SourceColumnName": "_c0", "SourceColumnID": "1", "SourceDataType": "string", "SourceDataFormat": "",
              "TargetColumnName": "A", "TargetDataType": "string"},
             {"SourceColumnName": "_c1", "SourceColumnID": "2", "SourceDataType": "int",
              "SourceDataFormat": "yyyyMMdd", "TargetColumnName": "D", "TargetDataType": "date"}]}
    assert validate_mapping(m) == []
    c = FeedContract.from_mapping(m)
    o = c.reader_options()
    assert o["sep"] == "|" and o["quote"] == '"' and o["multiLine"] == "true" and o["dateFormat"] == "yyyyMMdd"
    assert "escape" not in o and "header" not in o and "timestampFormat" not in o
    assert [f.name for f in c.read_schema().fields] == ["_c0", "_c1"]
    for key in list(m):
        bad = dict(m)
        del bad[key]
        assert validate_mapping(bad), key
    bad = dict(m, SourceToTargetMapping={"not": "a list"})
    assert validate_mapping(bad)
    bad = dict(m, SourceToTargetMapping=[{"SourceColumnName": "_c0"}])
    assert validate_mapping(bad)
    with pytest.raises(ContractError):
        FeedContract.from_mapping(dict(m, RecordDelimiter=None, SourceExtractType="weekly"))
    assert FeedContract.from_mapping(dict(m, RecordDelimiter="")).sep == ","
    inc = FeedContract.from_mapping(dict(m, SourceExtractType="incremental"))
    assert inc.warnings()
