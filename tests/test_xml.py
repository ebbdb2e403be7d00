"""XML record sets: hostile documents of the fixture list."""

import os

from pyspark.sql import functions as F

from loadkit.contracts import XmlColumn, XmlContract, XmlRecordSet
from loadkit.operators.upsert import with_key_expressions
from loadkit.sources.xml import contract_schema, load_xml_recordsets

HDR = [XmlColumn("DOCNUM", "HDR/DOCNUM", False), XmlColumn("CREATED_ON", "HDR/CREATED_ON", False)]
ACCT = [XmlColumn("ACCT_NO", "ACCT/ACCT_NO"), XmlColumn("FUNC", "ACCT/FUNC"), XmlColumn("GRP", "ACCT/GRP")]
CONTRACT = XmlContract("docs", "DOC", (
    XmlRecordSet("account", "ACCT", tuple(HDR + ACCT)),
    XmlRecordSet("text", "ACCT/TXT", tuple(HDR + [XmlColumn("ACCT_NO", "ACCT/ACCT_NO", False),
                                                  XmlColumn("LANG", "ACCT/TXT/LANG"),
                                                  XmlColumn("LONG", "ACCT/TXT/LONG")]),
                 key_columns={"acct_no": "<<tname>>.ACCT_NO", "lang": "nvl(<<tname>>.LANG, 'NA')"}),
    XmlRecordSet("company", "ACCT/COMP", tuple(HDR + [XmlColumn("ACCT_NO", "ACCT/ACCT_NO", False),
                                                     XmlColumn("COMPANY", "ACCT/COMP/COMPANY"),
                                                     XmlColumn("CURR", "ACCT/COMP/CURR")])),
))

DOC1 = """<?xml version="1.0"?>
<ns:ROOT xmlns:ns="urn:example:gl">
 <DOC>
  <HDR><DOCNUM>D1</DOCNUM><CREATED_ON>20240101</CREATED_ON></HDR>
  <ACCT>
   <TXT><LANG>EN</LANG><LONG>Cash &amp; bank
second line</LONG></TXT>
   <TXT><LONG>no language</LONG></TXT>
   <COMP><COMPANY>1000</COMPANY><CURR>USD</CURR></COMP>
   <COMP><COMPANY></COMPANY><CURR></CURR></COMP>
   <ACCT_NO>A1</ACCT_NO><FUNC>009</FUNC><GRP>G1</GRP>
  </ACCT>
  <ACCT><ACCT_NO>A2</ACCT_NO></ACCT>
 </DOC>
 <DOC>
  <HDR><DOCNUM>D2</DOCNUM></HDR>
  <ACCT><ACCT_NO>B1</ACCT_NO><COMP><COMPANY>2000</COMPANY></COMP></ACCT>
 </DOC>
</ns:ROOT>
"""
DOC2 = """<ROOT><DOC>
  <ACCT><ACCT_NO>C1</ACCT_NO><TXT><LANG>DE</LANG><LONG>Kasse</LONG></TXT></ACCT>
</DOC><DOC><HDR><DOCNUM>D4</DOCNUM></HDR></DOC></ROOT>
"""


def _load(spark, tmp):
    d = os.path.join(tmp, "xml")
    os.makedirs(d)
    with open(os.path.join(d, "f1.xml"), "w") as fh:
        fh.write(DOC1)
    with open(os.path.join(d, "f2.xml"), "w") as fh:
        fh.write(DOC2)
    return load_xml_recordsets(spark, d, CONTRACT, with_source_file=True)


def test_schema_arrays_follow_record_paths():
    s = contract_schema(CONTRACT)
    assert s["ACCT"].dataType.typeName() == "array"
    assert s["HDR"].dataType.typeName() == "struct"
    assert s["ACCT"].dataType.elementType["TXT"].dataType.typeName() == "array"


def test_record_sets(spark, tmp):
    sets = _load(spark, tmp)
    acct = {r["ACCT_NO"]: r for r in sets["account"].collect()}
    # parent fields after children are still read; document without children adds nothing
    assert acct["A1"]["FUNC"] == "009" and acct["A1"]["DOCNUM"] == "D1"
    assert acct["A2"]["FUNC"] is None and acct["A2"]["DOCNUM"] == "D1"
    assert acct["B1"]["DOCNUM"] == "D2"
    # second file lacks a header: nothing carries over from the first file
    assert acct["C1"]["DOCNUM"] is None
    assert set(acct) == {"A1", "A2", "B1", "C1"}

    txt = sets["text"].collect()
    by_lang = {r["LANG"]: r for r in txt}
    assert by_lang["EN"]["LONG"] == "Cash & bank\nsecond line"   # entity + newline arrive whole
    assert by_lang[None]["ACCT_NO"] == "A1"                        # child sees the parent key placed after it
    assert by_lang["DE"]["ACCT_NO"] == "C1"

    comp = sets["company"].collect()
    # a record is dropped only when every column is empty; the all-empty company
    # segment still carries its header and account values, so it stays
    companies = sorted((r["ACCT_NO"], r["COMPANY"] or "") for r in comp)
    assert companies == [("A1", ""), ("A1", "1000"), ("B1", "2000")]


def test_null_language_key_expression(spark, tmp):
    txt = _load(spark, tmp)["text"]
    keyed = with_key_expressions(txt, {"LANG": "nvl(<<tname>>.LANG, 'NA')"})
    assert sorted(r["LANG"] for r in keyed.collect()) == ["DE", "EN", "NA"]
    assert keyed.filter(F.col("_source_file").endswith("f2.xml")).count() == 1


def test_root_named_like_the_document_tag(spark, tmp):
    d = os.path.join(tmp, "xml3")
    os.makedirs(d)
    with open(os.path.join(d, "f.xml"), "w") as fh:
        fh.write('<?xml version="1.0"?>\n<DOCUMENTS>\n<DOC>\n<HDR><DOCNUM>D9</DOCNUM></HDR>'
                 '<ACCT><ACCT_NO>Z1</ACCT_NO></ACCT></DOC>\n<DOC kind="x">'
                 '<HDR><DOCNUM>D10</DOCNUM></HDR><ACCT><ACCT_NO>Z2</ACCT_NO></ACCT></DOC>\n</DOCUMENTS>\n')
    acct = load_xml_recordsets(spark, d, CONTRACT)["account"].collect()
    assert sorted((r["DOCNUM"], r["ACCT_NO"]) for r in acct) == [("D10", "Z2"), ("D9", "Z1")]
