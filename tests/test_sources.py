"""CSV loader details: header sanitising, typed reads, API date formats."""

import datetime as dt

from gigframe.sources.csv import read_header_named, read_typed, sanitise_header
from gigframe.sources.schemas import RAW_SETLISTS


def test_sanitise_header():
    assert sanitise_header(" Band ID ") == "Band_ID"


def test_header_named_reads_strings_and_renames(spark, tmp_path):
    p = tmp_path / "bands.csv"
    p.write_text('Band ID,Name,Extra\n007,"Slayer, Inc",x\n,Empty,y\n')
    df = read_header_named(spark, str(p), {"Band_ID": "band_id", "Name": "band_name"})
    assert df.columns == ["band_id", "band_name"]
    assert [tuple(r) for r in df.collect()] == [("007", "Slayer, Inc"), (None, "Empty")]


def test_typed_read_parses_both_date_formats(spark, tmp_path):
    p = tmp_path / "setlists.csv"
    header = ",".join(RAW_SETLISTS.fieldNames())
    p.write_text(header + "\n"
                 "s1,m,A,23-08-2019,v,V,C,,US,USA,1.5,,\n"
                 "s2,m,A,2019-08-23,v,V,C,,US,USA,,2.5,T\n")
    df = read_typed(spark, str(p), RAW_SETLISTS)
    got = {r.setlist_id: (r.event_date, r.latitude, r.longitude) for r in df.collect()}
    d = dt.date(2019, 8, 23)
    assert got == {"s1": (d, 1.5, None), "s2": (d, None, 2.5)}
