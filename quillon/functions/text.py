"""String expressions: normalisers, names, domains, titles. All are pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
LEGAL_WORDS = ["llc", "inc", "lp", "llp", "ltd", "co", "corp", "pllc", "pc", "plc", "sa", "ag", "the", "and", "of", "&"]
CREDENTIALS = ["jr", "sr", "ii", "iii", "iv", "v", "phd", "cfa", "cpa", "esq", "mba", "dr", "mr", "mrs", "ms", "cfp", "jd", "md"]
TITLE_WORDS = {
    "sr": "senior", "jr": "junior", "svp": "senior vice president", "vp": "vice president", "evp": "executive vice president",
    "cio": "chief investment officer", "ceo": "chief executive officer", "coo": "chief operating officer",
    "cfo": "chief financial officer", "mgr": "manager", "dir": "director",
}
TITLE_FILLERS = ["and", "the", "of"]
EMAIL = "[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}"
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyy"


def fold(text: Column) -> Column:
    """Letters and digits in lower case, anything else one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def compact(text: Column) -> Column:
    """Letters and digits in lower case only, as a comparison key."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]", "")


def plain(text: Column) -> Column:
    """Lower case without punctuation, white space runs as one space; letters of all scripts stay."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}_\\s]+", " "), "\\s+", " "))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def title_key(title: Column) -> Column:
    """A job title with its abbreviations spelled out and fillers dropped."""
    spelled = F.create_map(*(F.lit(x) for pair in TITLE_WORDS.items() for x in pair))
    kept = F.filter(words_of(plain(title)), lambda w: ~w.isin(TITLE_FILLERS))
    return F.array_join(F.transform(kept, lambda w: F.coalesce(spelled[w], w)), " ")


def sector_set(sectors: Column) -> Column:
    """The sorted set of normalised parts of a list of sector labels."""
    parts = F.flatten(F.transform(F.coalesce(sectors, F.array().cast("array<string>")), lambda s: F.split(F.coalesce(s, F.lit("")), "[,;/&]| and ")))
    return F.array_sort(F.array_distinct(F.filter(F.transform(parts, plain), lambda p: p != "")))


def without_accents(text: Column) -> Column:
    """Accents of the Latin-1 letters removed."""
    return F.translate(text, ACCENTED + ACCENTED.upper().replace("ß", ""), UNACCENTED + UNACCENTED.upper())


def name_parts(name: Column) -> tuple[Column, Column]:
    """(first, last) of a person's name for an address: the last is null for a single word, both if nothing is left."""
    base = F.regexp_replace(F.substring_index(name, ",", 1), "\\([^)]*\\)", " ")
    joined = F.regexp_replace(F.lower(without_accents(base)), "[’'\"“”-]", "")
    tokens = F.filter(words_of(F.regexp_replace(joined, "[^a-z]+", " ")), lambda w: ~w.isin(CREDENTIALS))
    kept = F.filter(tokens, lambda w, i: (i == 0) | (F.length(w) > 1))
    return F.try_element_at(kept, F.lit(1)), F.when(F.size(kept) > 1, F.element_at(kept, -1))


def registered_domain(url: Column) -> Column:
    """Host (with a port, if given) in lower case, without a leading www."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), "^www\\.", "")


def website(value: Column) -> Column:
    """A web address as it can be fetched: https where no scheme is given; null if it is none."""
    bare = F.trim(value)
    full = F.when(F.instr(bare, "://") > 0, bare).otherwise(F.concat(F.lit("https://"), bare))
    return F.when((bare != "") & (F.instr(bare, " ") == 0) & full.rlike("^https?://[^/?#]"), full)


def phone_digits(phone: Column) -> Column:
    """The last ten digits, null if there are fewer."""
    digits = F.regexp_replace(F.coalesce(phone, F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.right(digits, F.lit(10)))


def emails_in(text: Column) -> Column:
    """Addresses in a text, in lower case; the pattern is only tried where there is an @ at all."""
    found = F.transform(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)), F.lower)
    return F.when(F.contains(text, F.lit("@")), found).otherwise(F.array().cast("array<string>"))


def one_decimal(x: Column) -> Column:
    """A double from 0 as text with one decimal, rounded as C and Python do: by its exact value, ties to even.

    format_string rounds half up what the shortest decimal form shows. 20 x = 16 x + 4 x is compared exactly with the odd
    number between two tenths: the sum, and by how much it was rounded.
    """
    a, b = x * 16.0, x * 4.0
    low = F.floor((a + b) / 2.0)
    over = ((a + b) - (2 * low + 1).cast("double")) + (b - ((a + b) - a))
    tenths = low + F.when((over > 0) | ((over == 0) & (low % 2 == 1)), 1).otherwise(0)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def money_words(amount: Column) -> Column:
    """$1.2B, $3.4M or $5 from whole dollars; null stays null."""
    return (
        F.when(amount >= 1_000_000_000, F.concat(F.lit("$"), one_decimal(amount / 1e9), F.lit("B")))
        .when(amount >= 1_000_000, F.concat(F.lit("$"), one_decimal(amount / 1e6), F.lit("M")))
        .when(amount.isNotNull(), F.format_string("$%d", amount))
    )
