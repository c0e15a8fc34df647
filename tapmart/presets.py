"""Labels, patterns, bands and lookup rows.

Everything here is data that must hold exactly these values for results to be right. The
operators take these tables as parameters, so other label sets or bands need no code change.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

# ---------------------------------------------------------------- fixed values: file columns
REQUIRED_FILE_COLUMNS = (
    "transID",
    "payCardID",
    "payCardBank",
    "payCardName",
    "payCardSex",
    "tapInStops",
    "tapInStopsName",
    "tapInStopsLat",
    "tapInStopsLon",
    "tapInTime",
)
OPTIONAL_FILE_COLUMNS = (
    "payCardBirthDate",
    "corridorID",
    "corridorName",
    "direction",
    "stopStartSeq",
    "tapOutStops",
    "tapOutStopsName",
    "tapOutStopsLat",
    "tapOutStopsLon",
    "stopEndSeq",
    "tapOutTime",
    "payAmount",
)
# Columns whose text counts; the others are converted to numbers and times.
TEXT_FILE_COLUMNS = (
    "transID",
    "payCardID",
    "payCardBank",
    "payCardName",
    "payCardSex",
    "corridorID",
    "corridorName",
    "tapInStops",
    "tapInStopsName",
    "tapInTime",
    "tapOutStops",
    "tapOutStopsName",
)
NOT_NULL_FILE_COLUMNS = ("transID", "payCardID", "tapInStops", "tapInTime")
# Time texts beside ISO: month first, and day first where that cannot be.
TIME_FORMATS = (
    "M/d/yyyy H:mm[:ss]",
    "d/M/yyyy H:mm[:ss]",
    "M-d-yyyy H:mm[:ss]",
    "d-M-yyyy H:mm[:ss]",
    "yyyy/M/d H:mm[:ss]",
)

# Cell texts a flat file uses for "no value" (the pandas.read_csv defaults).
NA_TOKENS = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Characters that count as blank at the ends of a cell.
ASCII_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
ALL_BLANKS = ASCII_BLANKS + (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ---------------------------------------------------------------- fixed values: categories
CARD_BANKS = ("dki", "emoney", "brizzi", "flazz", "online", "bni")
OTHER_BANK = "lainnya"
GENDERS = ("M", "F")
GENDER_NOT_GIVEN = "Tidak Disebutkan"
NOT_KNOWN = "Tidak Diketahui"
UNKNOWN_ID = "UNKNOWN"

# Trip status. Source data spells the third one in two ways: all Latin letters, or
# with Cyrillic U+0435 and U+0442 at the end. Both are read as STATUS_INCOMPLETE.
STATUS_SUCCESS = "Sukses"
STATUS_FREE = "Gratis"
STATUS_INCOMPLETE = "Incomplete"
INCOMPLETE_SPELLINGS = ("Inkomplет", "Inkomplet")

# ---------------------------------------------------------------- fixed values: routes
# First matching pattern wins.
CORRIDOR_TYPES = (
    (r"^JAK\.", "Jak Lingko"),
    (r"^R\d", "Royaltrans"),
    (r"^M\d", "Mikrotrans"),
    (r"^\d+$", "BRT Utama"),
    (r"^\d+[A-Za-z]", "BRT Cabang"),
)
CORRIDOR_TYPE_DEFAULT = "Transjabodetabek"
CORRIDOR_TYPE_OTHER = "Lainnya"
ROUTE_NAME_SEPARATOR = " - "

# Corridor type, vehicle type, capacity.
VEHICLES = (
    ("BRT Utama", "Bus Articulasi AC", 140),
    ("BRT Cabang", "Bus Reguler AC", 95),
    ("Royaltrans", "Bus Premium", 35),
    ("Mikrotrans", "Angkot/Van", 14),
    ("Jak Lingko", "Bus Sedang AC", 50),
    ("Transjabodetabek", "Bus AKDP AC", 55),
    ("Lainnya", "Bus Umum", 60),
)
FLEET_PREFIX = "ARM"
FLEET_NO_ROUTE = "UNK"
FLEET_NO_DIRECTION = "0"
FLEET_NO_DATE = "00000000"
FLEET_NOTE = "ID sintetis Kaggle: ARM-corridorID-dir-YYYYMMDD"

# ---------------------------------------------------------------- fixed values: time of day
DAY_PARTS = ((5, 9, "Pagi"), (10, 14, "Siang"), (15, 18, "Sore"))
DAY_PART_DEFAULT = "Malam"


# ---------------------------------------------------------------- fixed values: rider bands
@dataclass(frozen=True)
class Bands:
    """Upper bounds in ascending order, the label above the last one, and the label for null.

    ``inclusive`` says whether a bound belongs to its band. Without ``null_label`` a null value
    takes the last label, as it would in a plain CASE chain.
    """

    bounds: tuple[tuple[int, str], ...]
    last: str
    inclusive: bool
    null_label: str | None = None


AGE_BANDS_EXCLUSIVE = Bands(
    ((20, "< 20 Tahun"), (31, "20-30 Tahun"), (41, "31-40 Tahun"), (55, "41-54 Tahun")),
    ">= 55 Tahun",
    inclusive=False,
)
AGE_BANDS_INCLUSIVE = Bands(
    ((22, "<= 22 thn"), (32, "23-32 thn"), (42, "33-42 thn"), (52, "43-52 thn")),
    ">= 53 thn",
    inclusive=True,
)
AGE_BANDS_NULL_AWARE = Bands(
    AGE_BANDS_INCLUSIVE.bounds, AGE_BANDS_INCLUSIVE.last, inclusive=True, null_label=NOT_KNOWN
)
SEGMENTS_EXCLUSIVE = Bands(
    ((20, "Pelajar"), (25, "Mahasiswa"), (55, "Pekerja")), "Lansia", inclusive=False
)
SEGMENTS_INCLUSIVE = Bands(
    ((17, "Pelajar"), (24, "Mahasiswa"), (55, "Pekerja")), "Lansia", inclusive=True
)
SEGMENTS_NULL_AWARE = Bands(
    SEGMENTS_INCLUSIVE.bounds, SEGMENTS_INCLUSIVE.last, inclusive=True, null_label=NOT_KNOWN
)
BIRTH_YEAR_RANGE = (1940, 2015)
REFERENCE_YEAR = 2023

# Home towns that make up the metropolitan region.
METRO_CITIES = (
    "Jakarta Pusat",
    "Jakarta Selatan",
    "Jakarta Barat",
    "Jakarta Utara",
    "Jakarta Timur",
    "Bogor",
    "Depok",
    "Tangerang",
    "Bekasi",
)
METRO_REGION = "Jabodetabek"
OTHER_REGION = "Lainnya"

# ---------------------------------------------------------------- fixed values: feedback
FEEDBACK_CATEGORIES = (
    (1, "Aplikasi Jaklingko", "Feedback tentang aplikasi mobile JakLingko"),
    (2, "Fasilitas Busway", "Feedback tentang fasilitas halte dan armada"),
    (3, "Umum", "Feedback umum tentang layanan secara keseluruhan"),
)

# ---------------------------------------------------------------- fixed values: unknown members
UNKNOWN_KEY = -1
UNKNOWN_SINCE = date(1900, 1, 1)
UNKNOWN_ROWS = {
    "date": {
        "date_key": UNKNOWN_KEY,
        "date": UNKNOWN_SINCE,
        "year": 1900,
        "quarter": 1,
        "month": 1,
        "month_name": "Unknown",
        "week_of_year": 1,
        "day_of_month": 1,
        "day_of_week": 1,
        "day_name": "Unknown",
        "is_weekend": 0,
        "is_holiday": 0,
    },
    "stop": {
        "stop_key": UNKNOWN_KEY,
        "stop_id": UNKNOWN_ID,
        "stop_name": "Halte Tidak Diketahui",
        "latitude": Decimal(0),
        "longitude": Decimal(0),
        "valid_from": UNKNOWN_SINCE,
        "is_current": 1,
    },
    "route": {
        "route_key": UNKNOWN_KEY,
        "route_id": UNKNOWN_ID,
        "route_name": "Rute Tidak Diketahui",
        "corridor_type": "Unknown",
        "valid_from": UNKNOWN_SINCE,
        "is_current": 1,
    },
    "rider": {
        "rider_key": UNKNOWN_KEY,
        "rider_id": -1,
        "rider_name": NOT_KNOWN,
        "card_bank": "Unknown",
        "gender": "U",
        "age_band": "Unknown",
        "rider_segment": "Unknown",
        "valid_from": UNKNOWN_SINCE,
        "is_current": 1,
    },
    "fleet": {
        "fleet_key": UNKNOWN_KEY,
        "fleet_id": UNKNOWN_ID,
        "route_id": UNKNOWN_ID,
        "direction": 0,
        "operating_date": UNKNOWN_SINCE,
        "vehicle_type": "Unknown",
        "capacity": 0,
        "is_synthetic": 1,
    },
    "feedback_category": {
        "feedback_category_key": UNKNOWN_KEY,
        "category_name": "Unknown",
        "description": "Tidak ada feedback",
    },
}

# ---------------------------------------------------------------- fixed values: load audit
AUDIT_OK = "Sukses"
AUDIT_FAILED = "Gagal"
AUDIT_PARTIAL = "Partial"
