"""Work lists around fetching: the frontier, pacing and retries, page bundles and lineage, the resolve queue, mail probes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import registered_domain
from quillon.operators.keyed import latest, top
from quillon.sources.pages import SOCIAL

# Sites that are no firm's own, answers worth another try, bounds, and signs of mail providers in order.
SKIP_DOMAINS = [
    "linkedin.com", "facebook.com", "twitter.com", "x.com", "instagram.com", "youtube.com", "crunchbase.com", "bloomberg.com", "wikipedia.org",
    "sec.gov", "adviserinfo.sec.gov", "google.com", "medium.com", "wechat.com", "weibo.com",
]
RETRY_STATUS, ATTEMPTS, LONGEST_WAIT, HOST_GAP = [429, 500, 502, 503, 504], 3, 30, 1.0
PROVIDERS = {
    "microsoft365": ["protection.outlook.com", "mail.protection.outlook.com", "outlook.com"], "google": ["google.com", "googlemail.com", "aspmx.l.google.com"],
    "proofpoint": ["pphosted.com", "ppe-hosted.com"], "mimecast": ["mimecast.com"], "barracuda": ["barracudanetworks.com", "cudamail.com"],
    "zoho": ["zoho.com", "zohomail.com"], "cisco_ironport": ["iphmx.com"], "amazon_ses": ["amazonaws.com"],
}
BUNDLE_TEXT = 60_000


def own_site(url: Column) -> Column:
    """Whether an address may be the firm's own: not a social network, an aggregator or a registry."""
    return ~F.coalesce(registered_domain(url).isin(SKIP_DOMAINS), F.lit(False))


def social(url: Column) -> Column:
    return F.coalesce(url.rlike(SOCIAL), F.lit(False))


def crawl_frontier(firms: DataFrame, n: int) -> DataFrame:
    """The next n firms (key, name, website, tier, reasons, raum) to fetch: named offices first, then tiers, the largest first."""
    order = F.when(F.contains("reasons", F.lit("name_contains_family_office")), 0).when(F.col("tier") == "strong", 1).when(F.col("tier") == "medium", 2).otherwise(3)
    return top(firms.filter(F.coalesce("website", F.lit("")) != ""), n, order, F.desc_nulls_last("raum"), F.asc("key"))


def host_turns(requests: DataFrame, gap: float = HOST_GAP) -> DataFrame:
    """Requests (id, url) with their host and the second at which each may start; one task owns a host."""
    at = F.row_number().over(Window.partitionBy("host").orderBy("id")) - 1
    return requests.withColumn("host", registered_domain(F.col("url"))).withColumn("starts", at * gap)


def fetched(tries: DataFrame) -> DataFrame:
    """What came of each address from its tries (url, attempt from 0, status, insecure, retry_after): the first final
    answer, or the last of ATTEMPTS, with the seconds waited before it.

    429 and server errors, and no answer at all, are tried again, after the seconds asked for or twice as long each time.
    """
    again = F.col("status").isNull() | F.col("status").isin(RETRY_STATUS)
    wait = F.least(F.coalesce(F.col("retry_after").cast("double"), F.pow(F.lit(2.0), F.col("attempt"))), F.lit(float(LONGEST_WAIT)))
    this = F.struct("attempt", "status", "insecure")
    ends = tries.filter(F.col("attempt") < ATTEMPTS).groupBy("url").agg(
        F.min(F.when(~again, this)).alias("end"), F.max(this).alias("last"), F.array_sort(F.collect_list(F.struct("attempt", wait.alias("wait")))).alias("waits"))
    got = F.coalesce("end", "last")
    waited = F.aggregate(F.filter("waits", lambda w: w["attempt"] < got["attempt"]), F.lit(0.0), lambda s, w: s + w["wait"])
    error = F.when(got["status"].isNull(), "unreachable").when(got["status"] >= 400, F.concat(F.lit("http_"), got["status"].cast("string")))
    return ends.select("url", got["status"].alias("status"), got["insecure"].alias("insecure"), (got["attempt"] + 1).alias("attempts"), waited.alias("waited"), error.alias("error"))


def page_bundles(captures: DataFrame, scope: DataFrame | None = None, most: int = BUNDLE_TEXT) -> DataFrame:
    """(key, pages, urls, text): the newest capture (key, url, id, text) of each address, texts joined in the order of addresses."""
    rows = captures if scope is None else captures.join(scope.select("key").distinct(), "key", "left_semi")
    newest = latest(rows, ["key", "url"], F.desc("id"))
    ordered = newest.groupBy("key").agg(F.count("*").alias("pages"), F.array_sort(F.collect_list(F.struct("url", "text"))).alias("p"))
    text = F.left(F.array_join(F.transform("p", lambda x: F.coalesce(x["text"], F.lit(""))), " "), F.lit(most))
    return ordered.select("key", "pages", F.transform("p", lambda x: x["url"]).alias("urls"), text.alias("text"))


def lineage(captures: DataFrame, fetched_urls: DataFrame) -> DataFrame:
    """(key, url, id): the newest capture of each address that was fetched."""
    return latest(captures.join(fetched_urls.select("key", "url").distinct(), ["key", "url"], "left_semi"), ["key", "url"], F.desc("id")).select("key", "url", "id")


def site_evidence(captures: DataFrame, categories: dict[str, str], phrase: str) -> DataFrame:
    """(key, phrases, category, signals): how often the newest pages say the phrase, the first category they state in the
    order of pages (home, about, others), and how many pages state each."""
    newest = latest(captures, ["key", "url"], F.desc("id"))
    place = F.when(F.col("kind") == "home", 0).when(F.col("kind") == "about", 1).otherwise(2)
    stated = F.filter(F.array(*(F.when(F.col("text").rlike(p), F.lit(c)) for c, p in categories.items())), lambda c: c.isNotNull())
    each = newest.select("key", place.alias("place"), "url", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(phrase)).alias("n"), F.coalesce(stated, F.array().cast("array<string>")).alias("stated"))
    first = F.min(F.when(F.size("stated") > 0, F.struct("place", "url", F.get("stated", F.lit(0)).alias("c"))))["c"]
    return each.groupBy("key").agg(F.sum("n").alias("phrases"), first.alias("category"), F.sum(F.size("stated")).alias("signals"))


def attempts(events: DataFrame) -> DataFrame:
    """(key, attempts, last_at): how often work on a key was tried without success, counted from the events themselves."""
    return events.filter("not succeeded").groupBy("key").agg(F.count("*").alias("attempts"), F.max("at").alias("last_at"))


def resolve_queue(candidates: DataFrame, tried: DataFrame, n: int) -> DataFrame:
    """The next n candidates (key, website, domain) without a usable domain: the least tried first, so that the queue rotates."""
    stranded = candidates.filter((F.coalesce("domain", F.lit("")) == "") & ((F.coalesce("website", F.lit("")) == "") | social(F.col("website"))))
    counted = stranded.join(tried.select("key", "attempts"), "key", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    return top(counted, n, F.asc("attempts"), F.asc("key"))


def reopened(queue: DataFrame, proofs: DataFrame) -> DataFrame:
    """Transitions of candidates (key, stage, status) whose domain has been proven (key, domain, basis): open again at the start."""
    proven = queue.filter(F.col("status") != "pending").join(proofs, "key")
    return proven.select("key", F.col("stage").alias("from_stage"), F.lit("discovered").alias("stage"), F.lit("pending").alias("status"), F.concat(F.lit("https://"), "domain").alias("website"), "basis")


def provider(hosts: Column) -> Column:
    """The provider of a mail host list by the first sign found in it."""
    joined, out = F.lower(F.array_join(hosts, " ")), F.when(F.lit(False), None)
    for label, signs in PROVIDERS.items():
        hit = F.lit(False)
        for sign in signs:
            hit = hit | F.contains(joined, F.lit(sign))
        out = out.when(hit, label)
    return F.coalesce(out, F.lit("other"))


def probed(answers: DataFrame) -> DataFrame:
    """Answers (key, pos, email, code) with a verdict, up to the first accepted address of a key or the first without a code."""
    verdict = F.when(F.col("code").between(200, 299), True).when(F.col("code").between(500, 599), False)
    ends = F.coalesce(verdict, F.lit(False)) | F.col("code").isNull()
    before = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return answers.withColumns({"verdict": verdict, "#done": F.coalesce(F.max(ends.cast("int")).over(before), F.lit(0))}).filter(F.col("#done") == 0).drop("#done")


def assessed(domains: DataFrame) -> DataFrame:
    """Domains (domain, hosts, resolves, code of a made-up address) as verification reads them: mx_ok, provider, catch_all."""
    catch_all = F.when(F.col("code").between(200, 299), True).when(F.col("code").between(500, 599), False)
    return domains.select("domain", (F.coalesce("resolves", F.lit(False)) & (F.size("hosts") > 0)).alias("mx_ok"), provider(F.col("hosts")).alias("provider"), catch_all.alias("catch_all"))


def embedded(texts: DataFrame, encode: Callable[[list[str]], list[list[float]]], batch: int = 500) -> DataFrame:
    """(id, vector) of texts (id, text), by an encoder that is given at most `batch` texts at once; null reads as empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                yield pd.DataFrame({"id": part["id"], "vector": encode([t or "" for t in part["text"]])})

    return texts.select("id", "text").mapInPandas(run, f"id {dict(texts.dtypes)['id']}, vector array<double>")
