"""URL verdicts from a weighted vocabulary, after explicit rules.

Every url, from behind its `://` on, with query and fragment, is searched for all terms at once (an
Aho-Corasick automaton). A hit counts only between boundaries: the characters around it, if any, are
not letters or digits of any script; an escape like `%20` is a boundary. One strict term blocks, as do
SOFT_LIMIT different soft terms; a term and its plurals are one. Rules on (host, path prefix) come first and the longest that fits decides.

Nulls: a null url has an empty host and path, fits no rule and holds no term, so it is allowed. A
url without `://` has an empty host and path too, but is searched whole. Very long urls are searched
whole. Repeated rows each get their verdict. Empty input: an empty result. Extra columns are kept;
the columns that judge writes take the place of ones of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanworks.session import table

#: Fixed rules: (rule, verdict).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))

#: The vocabulary: terms of one meaning (adult, gambling, pharmacy, ad fraud; four languages) weigh 2,
#: terms that also have a harmless meaning, and bait words, weigh 1. Plurals in s follow by rule.
STRICT_TERMS = ("adclick", "adserver", "adultdating", "adultsex", "adultvideo", "bangbros", "bestiality", "blowjob", "brazzers", "bukkake", "callgirl", "camgirl", "camsex", "cialis", "clickfraud", "creampie", "cumshot", "deepfakeporn", "doorwaypage", "escortservice", "filmporno", "gangbang", "hardcore", "hentai", "hurensex", "kamagra", "keygen", "levitra", "linkfarm", "livesex", "milf", "nsfw", "onlinebetting", "onlinecasino", "onlinegambling", "onlinepharmacy", "onlinepoker", "onlyfansleak", "pelisporno", "phonesex", "popunder", "porn", "pornhub", "porno", "pornografia", "pornografie", "pornographic", "pornographie", "pornography", "pornstar", "redtube", "sexcam", "sexchat", "sexdating", "sexfilm", "sexkontakte", "sexshop", "sextape", "sextoy", "sexvideo", "sildenafil", "spamdexing", "sportsbetting", "sportsbook", "tadalafil", "upskirt", "viagra", "videoporno", "warez", "xhamster", "xnxx", "xvideos", "xxx", "youporn")
SOFT_TERMS = ("ads", "adult", "adulte", "adulto", "advert", "affiliate", "ambien", "apuesta", "argent", "babe", "baccarat", "banner", "barato", "bet", "betting", "bettor", "billig", "bingo", "blackjack", "bonus", "bonuses", "bookie", "bookmaker", "cam", "casino", "cheap", "cheapest", "clickbait", "crack", "cracked", "dating", "desnuda", "desnudo", "discount", "erotic", "erotica", "erotico", "erotik", "erotique", "escort", "escorte", "farmacia", "fetish", "fetishes", "free", "freebie", "gamble", "gambler", "gambling", "ganar", "gewinn", "gewinnspiel", "girls", "gluecksspiel", "gratis", "gratuit", "hot", "jackpot", "kasino", "kink", "kinky", "kostenlos", "lesbians", "lingerie", "loteria", "loterie", "lotterie", "lotteries", "lottery", "lotto", "medikament", "meds", "nackt", "naked", "nude", "nudist", "nudity", "opioid", "pastilla", "pharma", "pharmacie", "pharmacies", "pharmacy", "phentermine", "pill", "pilule", "poker", "popup", "potenzmittel", "premio", "prize", "rabatt", "rencontre", "roulette", "ruleta", "serialz", "sex", "sexe", "sexo", "sexual", "sexy", "slot", "sorteo", "spam", "spammer", "spammy", "spielautomat", "spielcasino", "sponsored", "steroid", "strip", "stripper", "striptease", "swinger", "tablets", "teen", "torrent", "track", "tracker", "tracking", "tragaperras", "tramadol", "valium", "wager", "wagering", "webcam", "wette", "wetten", "win", "winner", "winning", "xanax")


def forms(terms: tuple[str, ...]) -> dict[str, str]:
    """Each form that is searched, and the term that it counts as: a plural in s, es or ies counts as its singular, and every term has one in s."""
    known, out = set(terms), {}
    for t in terms:
        singles = [t[:-3] + "y" if t.endswith("ies") else "", t[:-2] if t.endswith("es") else "", t[:-1] if t.endswith("s") else ""]
        out[t] = next((x for x in singles if x in known), t)
    return {t + "s": base for t, base in out.items() if not t.endswith("s")} | out


STRICT, SOFT = forms(STRICT_TERMS), forms(SOFT_TERMS)
#: One strict term blocks, as do so many different soft ones.
SOFT_LIMIT = 2
#: What the SQL form needs: a term's forms between boundaries.
BOUNDED = "(^|[^\\p{{L}}\\p{{N}}])({})([^\\p{{L}}\\p{{N}}]|$)"


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.coalesce(_lower(host), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def searched(url: Column) -> Column:
    """What is searched for terms: all behind the first `://`, or the whole url; A-Z lower-cased, escapes as spaces."""
    return F.coalesce(_spaced(_lower(F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(url))), F.lit(""))


def _spaced(c: Column) -> Column:
    return F.regexp_replace(c, "%[0-9a-f]{2}", " ")


def _lower(c: Column) -> Column:
    """A-Z only, at any locale."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def term_hits(strict: dict[str, str], soft: dict[str, str]):
    """A pandas UDF: text (lower case) to struct<strict, soft>, the numbers of different terms hit by their forms."""

    @F.pandas_udf("strict int, soft int")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = ahocorasick.Automaton()
        for form in {*strict, *soft}:
            machine.add_word(form, form)
        machine.make_automaton()
        for texts in batches:
            rows = []
            for text in texts:
                found = {form for end, form in machine.iter(text) if not _inner(text[max(end - len(form), 0) : end - len(form) + 1]) and not _inner(text[end + 1 : end + 2])}
                rows.append(tuple(len({terms[f] for f in found if f in terms}) for terms in (strict, soft)))
            yield pd.DataFrame(rows, columns=["strict", "soft"])

    return hits


def _inner(c: str) -> bool:
    """A letter or digit of any script; nothing at an end of the text."""
    return c.isalnum()


def judge(df: DataFrame, url_col: str = "url", rules=RULES, strict: dict[str, str] = STRICT, soft: dict[str, str] = SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """df with host, path, rule, verdict, strict_hits and soft_hits."""
    df = df.withColumn("_searched", searched(F.col(url_col)))
    df = df.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: len(r[0])):  # the longest is the outermost
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    hits = term_hits(strict, soft)
    df = df.withColumn("_hits", hits(F.col("_searched")))
    own = F.when((F.col("_hits.strict") >= 1) | (F.col("_hits.soft") >= soft_limit), "block").otherwise("allow")
    return (
        df.withColumn("rule", rule)
        .withColumn("verdict", F.coalesce(verdict, own))
        .withColumn("strict_hits", F.col("_hits.strict"))
        .withColumn("soft_hits", F.col("_hits.soft"))
        .drop("_hits", "_searched")
    )


def op4_url_terms(spark, sf_dir):
    """The verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def _sql() -> str:
    named = lambda terms: [[f for f, b in terms.items() if b == base] for base in dict.fromkeys(terms.values())]
    hits = lambda terms: " + ".join(f"CAST(regexp_matches(t, '{BOUNDED.format('|'.join(own))}') AS INT)" for own in named(terms))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    fits = lambda r: f"(host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}')"
    rules = sorted(RULES, key=lambda r: -len(r[0]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in rules) + " END"
    said = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{v}'" for r, v in rules) + " END"
    return f"""
WITH r AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE url END, '') AS whole FROM pages),
s AS (SELECT page_id, regexp_replace({lower("whole")}, '%[0-9a-f]{{2}}', ' ', 'g') AS t, {lower("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
c AS (SELECT *, {hits(STRICT)} AS strict_hits, {hits(SOFT)} AS soft_hits FROM s)
SELECT page_id, host, path, {rule} AS rule, coalesce({said}, CASE WHEN strict_hits >= 1 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, strict_hits, soft_hits FROM c"""


OP4_SQL = _sql()
