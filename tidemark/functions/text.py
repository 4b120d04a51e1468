"""Text functions as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with a stroke, which have no decomposition, and their base letters.
STRUCK, UNSTRUCK = "đĐłŁøØħĦŧŦ", "dDlLoOhHtT"


def _accents() -> tuple[str, str]:
    """All precomposed letters of the Latin blocks that decompose to an ASCII letter, and those letters."""
    whole = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))}
    pairs = [(c, d[0]) for c, d in whole.items() if len(d) > 1 and d[0].isascii() and d[0].isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()
COMBINING = r"[\u0300-\u036f]"


def unaccent(text: Column) -> Column:
    """Letters without accents; a stroke through a letter counts as one."""
    return F.translate(F.regexp_replace(text, COMBINING, ""), ACCENTED + STRUCK, PLAIN + UNSTRUCK)


def fold(text: Column) -> Column:
    """Lower case without accents, for comparison."""
    return unaccent(F.lower(text))


# Fixed value: source prefixes that titles carry.
TITLE_PREFIX = r"(?iu)^\s*(\(chinhphu\.vn\)\s*-?|\(đtck\)|\(dtck\)|bnews)\s*"
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def unescape(text: Column) -> Column:
    """The named references that feeds use; ``&amp;`` last, so that it is decoded once."""
    for k, v in _ENTITIES.items():
        text = F.replace(text, F.lit(k), F.lit(v))
    return text


def norm_title(title: Column) -> Column:
    """Key of a title: no source prefix, no accents, only ``a-z0-9``; null: empty."""
    bare = F.regexp_replace(unescape(F.coalesce(title, F.lit(""))), TITLE_PREFIX, "")
    return F.regexp_replace(fold(bare), "[^a-z0-9]", "")


# Fixed value: query parameters that don't change a page.
DROP_QUERY = r"^(utm_.*|gidzl|fbclid)=.*|^(gidzl|fbclid)$|^utm_[^=]*$"


def canonical_url(url: Column) -> Column:
    """HTTPS, lower-case host, no tracking parameters, no fragment, no closing slash."""
    u = F.trim(url)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    scheme = F.when(scheme.isin("http", "https"), "https").otherwise(scheme)
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(DROP_QUERY)), "&")
    whole = F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path))
    return F.when(kept != "", F.concat(whole, F.lit("?"), kept)).otherwise(whole)


def trigrams(text: Column) -> Column:
    """Distinct trigrams of folded words, each padded by two leading blanks and one closing."""
    words = F.filter(F.split(fold(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))))


def similarity(a: Column, b: Column) -> Column:
    """Shared over all distinct trigrams of two trigram arrays; two empty ones: 0."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union > 0, both.cast("double") / union).otherwise(F.lit(0.0))


def tokens(text: Column) -> Column:
    """Search tokens: lower-case runs of letters and digits, position is index."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def matches_all(doc: Column, words: list[str]) -> Column:
    """Every word occurs; no word matches nothing."""
    if not words:
        return F.lit(False)
    return F.size(F.array_except(F.array(*map(F.lit, words)), doc)) == 0


def matches_phrase(doc: Column, words: list[str]) -> Column:
    """The words occur next to each other in order."""
    if not words:
        return F.lit(False)
    joined = lambda xs: F.concat(F.lit("\x01"), F.array_join(xs, "\x01"), F.lit("\x01"))
    return F.contains(joined(doc), F.lit("\x01" + "\x01".join(words) + "\x01"))


# Tickers that are also common abbreviations.
AMBIGUOUS = (
    "USD EUR GBP JPY CNY KRW THB SGD CAD AUD CHF VND CPI GDP PMI FDI ODA IMF WTO WHO ADB ETF IPO ESG EVN VAT BOT PPP CEO CFO AGM ATC ATO HCM NAV API SEA CNG LNG POS TOP NET VNX ABC SME OTC ROE ROA EPS DXY BTC ETH ECB FED BOJ BOE VN30 HNX30 VN100"
).split()
EXCHANGES = ("HNX", "HOSE", "UPCOM")
TICKER = r"\b[A-Z][A-Z0-9]{2}\b"
FILING_URL = r"/du-lieu/([A-Z0-9]{2,6})-\d+/[^\"'\s]*\.chn"


def tickers_in(text: Column, listed: Column) -> Column:
    """Listed, unambiguous tickers of a text in order of first mention; ``listed`` is an array."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TICKER), F.lit(0)))
    return F.array_except(F.array_intersect(found, listed), F.array(*map(F.lit, AMBIGUOUS)))


def ticker_of_url(url: Column) -> Column:
    """Ticker of a filing's URL, null for exchange notices and other URLs."""
    t = F.regexp_extract(url, FILING_URL, 1)
    return F.when((t != "") & ~t.isin(*EXCHANGES), t)


def title_dates(title: Column) -> Column:
    """Sorted distinct ``day/month`` mentions, written with a slash."""
    found = F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(r"\b\d{1,2}[/-]\d{1,2}\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda d: F.replace(d, F.lit("-"), F.lit("/")))))


def dates_agree(a: Column, b: Column) -> Column:
    """Titles that both name days must name the same."""
    return (F.size(title_dates(a)) == 0) | (F.size(title_dates(b)) == 0) | (title_dates(a) == title_dates(b))


def parse_number(text: Column) -> Column:
    """Numbers like ``6.307,47``; anything else: null."""
    clean = F.trim(text)
    shaped = clean.rlike(r"^-?(\d{1,3}(\.\d{3})+|\d+)(,\d+)?$")
    return F.when(shaped, F.replace(F.replace(clean, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(38,10)"))


def format_number(x: Column, places: int) -> Column:
    """``1.234.567,8``: dots between thousands, a comma before decimals."""
    return F.translate(F.format_number(x, places), ",.", ".,")


# Units of metrics with factor, decimals and what follows the number; money by its name in small amounts.
METRIC_UNITS = {"ty_le_thap_phan": (100, 2, "%"), "lan": (1, 2, " lần"), "VND/CP": (1, 0, " đ/cp"), "co_phieu": (1, 0, " cp"), "so_luong": (1, 0, "")}
MONEY = {"VND": " đ", "USD": " USD"}
BILLION = 10**9


def _money(x: Column, unit: Column, names: dict[str, str]) -> tuple[Column, Column]:
    """Whether ``unit`` is money, and the amount: in billions with one decimal from a billion on, by size."""
    small = F.create_map(*[F.lit(v) for kv in names.items() for v in kv])[unit]
    large = F.concat(format_number(x / BILLION, 1), F.lit(" tỷ "), unit)
    return unit.isin(*names), F.when(F.abs(x) >= BILLION, large).otherwise(F.concat(format_number(x, 0), small))


def display_metric(x: Column, unit: Column) -> Column:
    """A metric with its unit; shares are shown in percent, unknown units with two decimals, no unit as null."""
    money, amount = _money(x, unit, {"VND": MONEY["VND"]})
    shown = F.when(money, amount)
    for name, (factor, places, end) in METRIC_UNITS.items():
        shown = shown.when(unit == name, F.concat(format_number(x * factor, places), F.lit(end)))
    return shown.when(unit.isNotNull(), F.concat(format_number(x, 2), F.lit(" "), unit))


def display_series(x: Column, unit: Column) -> Column:
    """A value of a series with its free-text unit; percent is shown as it is, whole numbers without decimals."""
    money, amount = _money(x, unit, MONEY)
    number = F.when(x == F.floor(x), format_number(x, 0)).otherwise(format_number(x, 2))
    return F.when(money, amount).when(unit == "%", F.concat(format_number(x, 2), F.lit("%"))).when(unit.isNull(), format_number(x, 2)).otherwise(F.concat(number, F.lit(" "), unit))


def snake(name: Column) -> Column:
    """camelCase to snake_case."""
    return F.lower(F.regexp_replace(name, r"(?<=[a-z0-9])([A-Z])", "_$1"))


def content_key(fields: Column, event: Column | None = None, bits: int = 256) -> Column:
    """Digest of a map's compact JSON with sorted keys, after ``event`` and a NUL if given."""
    text = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(fields))))
    text = text if event is None else F.concat(event, F.lit("\x00"), text)
    return F.sha1(text) if bits == 160 else F.sha2(text, bits)
