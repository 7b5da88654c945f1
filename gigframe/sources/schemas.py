"""Raw table schemas, the raw table registry and fixed lookup rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, L, D, B, DT, I = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.IntegerType()


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Raw tables as the staging models read them (after load-time renames).
RAW_BANDS = _struct(("band_id", S), ("band_name", S), ("country", S), ("genre", S), ("status", S))
RAW_ALBUMS = _struct(("band_id", S), ("album_name", S), ("album_type", S), ("year", S), ("reviews", S))
RAW_LABELS = _struct(("label_id", S), ("band_id", S), ("label_name", S), ("specialization", S),
                     ("status", S), ("country", S))
RAW_SETLISTS = _struct(("setlist_id", S), ("artist_mbid", S), ("artist_name", S), ("event_date", DT),
                       ("venue_id", S), ("venue_name", S), ("city_name", S), ("state", S),
                       ("country_code", S), ("country_name", S), ("latitude", D), ("longitude", D),
                       ("tour_name", S))
RAW_SONGS = _struct(("setlist_id", S), ("song_name", S), ("set_name", S), ("encore", L),
                    ("is_cover", B), ("cover_artist_name", S), ("is_tape", B))
RAW_BAND_MAPPING = _struct(("ma_band_id", L), ("ma_band_name", S), ("sfm_mbid", S),
                           ("sfm_artist_name", S), ("match_type", S))

# Search candidates for the band -> artist match (one row per search hit).
ARTIST_CANDIDATES = _struct(("band_id", S), ("band_name", S), ("rank", I), ("name", S), ("mbid", S))

# One landed API page per JSON line. ``mbid`` is added by the lander (the
# artist the page was requested for); the rest is the API response.
_SONG = _struct(("name", S), ("tape", B), ("cover", T.MapType(S, S)))
_SET = _struct(("name", S), ("encore", I), ("song", T.ArrayType(_SONG)))
_SETLIST = _struct(
    ("id", S), ("eventDate", S),
    ("artist", _struct(("mbid", S), ("name", S))),
    ("venue", _struct(("id", S), ("name", S),
                      ("city", _struct(("name", S), ("state", S),
                                       ("coords", _struct(("lat", D), ("long", D))),
                                       ("country", _struct(("code", S), ("name", S))))))),
    ("tour", _struct(("name", S))),
    ("sets", _struct(("set", T.ArrayType(_SET)))),
)
API_PAGE = _struct(("mbid", S), ("itemsPerPage", I), ("page", I), ("total", I),
                   ("setlist", T.ArrayType(_SETLIST)))


@dataclass(frozen=True)
class RawTable:
    """One landed source: its file name, header renames and typed schema.

    ``renames`` maps the sanitised CSV header (blanks -> '_') to our names;
    ``None`` means the header already carries our names.
    """
    name: str
    filename: str
    schema: T.StructType
    renames: dict | None = field(default=None)
    all_string: bool = True


# The landed files, their header columns and our column names.
RAW_TABLES = {
    "bands": RawTable("bands", "metal_bands.csv", RAW_BANDS,
                      {"Band_ID": "band_id", "Name": "band_name", "Country": "country",
                       "Genre": "genre", "Status": "status"}),
    "albums": RawTable("albums", "all_bands_discography.csv", RAW_ALBUMS,
                       {"Album_Name": "album_name", "Type": "album_type", "Year": "year",
                        "Reviews": "reviews", "Band_ID": "band_id"}),
    "labels": RawTable("labels", "labels_roster.csv", RAW_LABELS,
                       {"Label_ID": "label_id", "Band_ID": "band_id", "Name": "label_name",
                        "Specialization": "specialization", "Status": "status",
                        "Country": "country"}),
    "setlists": RawTable("setlists", "setlists.csv", RAW_SETLISTS, None, all_string=False),
    "songs": RawTable("songs", "songs.csv", RAW_SONGS, None, all_string=False),
    "band_mapping": RawTable("band_mapping", "band_mapping.csv", RAW_BAND_MAPPING, None,
                             all_string=False),
}

# ISO 3166 alpha-2 -> alpha-3 codes used by the country map
# (147 entries, alphabetical by alpha-2). Codes not listed map to NULL.
ALPHA2_TO_ALPHA3 = {
    "AD": "AND", "AE": "ARE", "AF": "AFG", "AG": "ATG", "AL": "ALB",
    "AM": "ARM", "AO": "AGO", "AR": "ARG", "AT": "AUT", "AU": "AUS",
    "AZ": "AZE", "BA": "BIH", "BB": "BRB", "BD": "BGD", "BE": "BEL",
    "BG": "BGR", "BH": "BHR", "BI": "BDI", "BJ": "BEN", "BN": "BRN",
    "BO": "BOL", "BR": "BRA", "BS": "BHS", "BT": "BTN", "BW": "BWA",
    "BY": "BLR", "BZ": "BLZ", "CA": "CAN", "CD": "COD", "CF": "CAF",
    "CG": "COG", "CH": "CHE", "CI": "CIV", "CL": "CHL", "CM": "CMR",
    "CN": "CHN", "CO": "COL", "CR": "CRI", "CU": "CUB", "CY": "CYP",
    "CZ": "CZE", "DE": "DEU", "DJ": "DJI", "DK": "DNK", "DO": "DOM",
    "DZ": "DZA", "EC": "ECU", "EE": "EST", "EG": "EGY", "ER": "ERI",
    "ES": "ESP", "ET": "ETH", "FI": "FIN", "FR": "FRA", "GA": "GAB",
    "GB": "GBR", "GE": "GEO", "GH": "GHA", "GR": "GRC", "GT": "GTM",
    "GY": "GUY", "HN": "HND", "HR": "HRV", "HT": "HTI", "HU": "HUN",
    "ID": "IDN", "IE": "IRL", "IL": "ISR", "IN": "IND", "IQ": "IRQ",
    "IR": "IRN", "IS": "ISL", "IT": "ITA", "JM": "JAM", "JO": "JOR",
    "JP": "JPN", "KE": "KEN", "KG": "KGZ", "KH": "KHM", "KR": "KOR",
    "KW": "KWT", "KZ": "KAZ", "LA": "LAO", "LB": "LBN", "LK": "LKA",
    "LR": "LBR", "LT": "LTU", "LU": "LUX", "LV": "LVA", "LY": "LBY",
    "MA": "MAR", "MD": "MDA", "ME": "MNE", "MG": "MDG", "MK": "MKD",
    "ML": "MLI", "MM": "MMR", "MN": "MNG", "MT": "MLT", "MX": "MEX",
    "MY": "MYS", "MZ": "MOZ", "NA": "NAM", "NE": "NER", "NG": "NGA",
    "NI": "NIC", "NL": "NLD", "NO": "NOR", "NP": "NPL", "NZ": "NZL",
    "OM": "OMN", "PA": "PAN", "PE": "PER", "PH": "PHL", "PK": "PAK",
    "PL": "POL", "PR": "PRI", "PT": "PRT", "PY": "PRY", "QA": "QAT",
    "RO": "ROU", "RS": "SRB", "RU": "RUS", "RW": "RWA", "SA": "SAU",
    "SE": "SWE", "SG": "SGP", "SI": "SVN", "SK": "SVK", "SN": "SEN",
    "SV": "SLV", "SY": "SYR", "TH": "THA", "TN": "TUN", "TR": "TUR",
    "TW": "TWN", "TZ": "TZA", "UA": "UKR", "UG": "UGA", "US": "USA",
    "UY": "URY", "UZ": "UZB", "VE": "VEN", "VN": "VNM", "ZA": "ZAF",
    "ZM": "ZMB", "ZW": "ZWE",
}
