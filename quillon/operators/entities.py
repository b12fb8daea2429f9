"""Entity resolution: duplicates by domain, candidates against what is held, domain guesses and their proof, fact changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import LEGAL_WORDS, compact, plain, sector_set, title_key, words_of

# Words of firm names that identify nothing.
COMMON_WORDS = [
    "capital", "wealth", "management", "advisors", "advisers", "advisory", "partners", "group", "financial", "finance", "investment",
    "investments", "investing", "asset", "assets", "family", "office", "offices", "associates", "holdings", "trust", "private", "global",
    "national", "international", "american", "america", "first", "new", "old", "north", "south", "east", "west", "company", "companies",
    "corporation", "incorporated", "services", "service", "planning", "consulting", "consultants", "counsel", "securities", "fund", "funds",
    "equity", "strategies", "strategic", "solutions", "resources", "insurance", "retirement", "portfolio", "portfolios", "fiduciary",
    "independent", "premier", "summit", "heritage", "legacy", "pinnacle", "united",
]
ENDINGS = [".com", ".net", ".co"]


def same_domain(entities: DataFrame, share: int = 1000) -> DataFrame:
    """(key, domain, others): entities (key, domain) that share a domain, with the others of it, in order.

    Rows of a domain are dealt into parts of about `share`, each of which gets the list of its keys: what is given out is
    the square of a group by its nature, but no task has to write all of it.
    """
    groups = entities.groupBy("domain").agg(F.array_sort(F.collect_set("key")).alias("keys"), F.count("*").alias("rows")).filter(F.size("keys") > 1)
    parts = F.ceil(F.col("rows") / share).cast("int")
    sizes = entities.groupBy("domain").agg(F.count("*").alias("rows")).select("domain", parts.alias("parts"))
    dealt = entities.join(sizes, "domain").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    lists = groups.select("domain", "keys", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return dealt.join(lists.hint("merge"), ["domain", "part"]).select("key", "domain", F.coalesce(F.array_remove("keys", F.col("key")), "keys").alias("others"))


def not_held(candidates: DataFrame, *held: DataFrame) -> DataFrame:
    """Candidates (key, name) whose key and compacted name no held table (key, name) has."""
    known = held[0].select("key", "name")
    for more in held[1:]:
        known = known.union(more.select("key", "name"))
    keys = known.select("key").distinct()
    names = known.select(compact(F.col("name")).alias("#name")).distinct()
    return candidates.join(keys, "key", "left_anti").withColumn("#name", compact(F.col("name"))).join(names, "#name", "left_anti").drop("#name")


def name_words(name: Column) -> Column:
    return F.filter(words_of(plain(name)), lambda w: ~w.isin(LEGAL_WORDS))


def distinctive(name: Column) -> Column:
    """Words of a name that identify the firm."""
    return F.filter(name_words(name), lambda w: ~w.isin(COMMON_WORDS) & (F.length(w) > 2))


def domain_guesses(name: Column, most: int = 8) -> Column:
    """Domains (domain, full) that a firm of this name may own: longer stems first, each with three endings."""
    words, own = name_words(name), distinctive(name)
    whole = F.array_join(words, "")
    head = lambda ws, n: F.array_join(F.slice(ws, 1, n), "")
    stems = F.array(whole, head(words, 3), head(words, 2), F.array_join(own, ""), head(own, 2), head(own, 1), head(words, 1))
    fit = F.array_distinct(F.filter(stems, lambda s: F.length(s).between(3, 40)))
    each = F.transform(fit, lambda s: F.transform(F.array(*map(F.lit, ENDINGS)), lambda e: F.struct(F.concat(s, e).alias("domain"), (s == whole).alias("full"))))
    return F.slice(F.flatten(each), 1, most)


def domain_proof(name: Column, page: Column, full: Column, phone: Column, city: Column) -> tuple[Column, Column]:
    """(proven, hits): the page shows a distinctive word, and the stem is the whole name or phone or city corroborate."""
    low = F.regexp_replace(F.lower(page), "\\s+", " ")
    hits = F.filter(distinctive(name), lambda w: F.contains(low, w))
    by_phone = F.coalesce(F.contains(F.regexp_replace(low, "[^0-9]", ""), phone), F.lit(False))
    by_city = F.coalesce((F.length(city) > 3) & F.contains(low, F.lower(city)), F.lit(False))
    return (F.size(hits) > 0) & (full | by_phone | by_city), hits


def fact_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What changed between two profiles (key, sectors, thesis, team: map of name to title) of a key.

    Sectors compare as sets of normalised parts, the thesis without case and punctuation, people by name; a new title
    counts only where the person stays.
    """
    a, b = (d.select("key", *(F.col(c).alias(f"{x}_{c}") for c in ("sectors", "thesis", "team"))) for d, x in ((old, "a"), (new, "b")))
    both = a.join(b, "key")
    names = lambda m: F.array_sort(F.transform(F.map_keys(m), plain))
    titled = lambda m: F.transform(F.map_entries(m), lambda e: F.concat_ws("|", plain(e["key"]), title_key(e["value"])))
    stay = F.array_intersect(names(F.col("a_team")), names(F.col("b_team")))
    moved = F.filter(F.array_except(titled(F.col("b_team")), titled(F.col("a_team"))), lambda t: F.array_contains(stay, F.substring_index(t, "|", 1)))
    return both.select(
        "key",
        (sector_set(F.col("a_sectors")) != sector_set(F.col("b_sectors"))).alias("sectors_changed"),
        (plain(F.col("a_thesis")) != plain(F.col("b_thesis"))).alias("thesis_changed"),
        F.size(F.array_except(names(F.col("a_team")), names(F.col("b_team")))).alias("gone"),
        F.size(F.array_except(names(F.col("b_team")), names(F.col("a_team")))).alias("joined"),
        F.size(moved).alias("retitled"),
    )
