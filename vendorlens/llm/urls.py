"""URL filters: host and path rules, then a weighted vocabulary.

The rules are plain DataFrame functions. A URL that no rule fits is judged by
its words: an Aho-Corasick automaton finds every strict and soft term, a hit
counts when it stands between characters other than a-z and 0-9, and one
strict term or several distinct soft terms reject the URL. A term and its plural
are one term. Terms are common words of pornography, gambling, drug and loan
spam and malware, chosen without regard to any table.

Defined cases: a null URL or one without '://' has an empty host and path,
no rule fits it, and its words (none for null) decide; rows may repeat.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import ascii_lower, read

# Fixed rules: (action, host, start of the path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
# One of these is enough. Terms stand for their plural too.
STRICT_TERMS = """
adult-content adult-dating adult-film adult-movie adult-video adultfriend anal ass-fuck bangbros bbw-porn bdsm bestiality
big-tits bitch blackjack blowjob boobs bookie bookmaker brothel bukkake cam-girl camgirl camsex casino chaturbate cialis
clit cocks counterfeit crack-serial craps creampie cumshot cunt darknet-market deepthroat dildo dirty-talk ejaculation
erotica escort escort-service fake-id fake-passport femdom fetish fuck fucking gangbang gambling gangbang-video handjob
hardcore hentai hookup-site horny incest jackpot-city jailbait keygen kinky ladyboy levitra lolita malware masturbation
milf nsfw nude-girl nudes nudity onlyfans online-betting online-casino online-gambling online-poker online-slot orgasm
orgy paysite phentermine phishing porn porn-site pornhub pornstar porno pornographic poker-online prostitute pussy
ransomware redtube roulette serialz sex-cam sex-chat sex-shop sex-tape sex-toy sex-video sexcam sexchat sexshop shemale
slot-machine slot-online slut spam sportsbook spyware stripclub striptease swinger teen-sex threesome tits torrentz
tramadol tranny upskirt viagra voyeur warez webcam-girl whore xanax xhamster xnxx xvideo xxx youporn
""".split()
# Two different ones of these are enough.
SOFT_TERMS = """
adult ads affiliate amateur babe bargain bet betting bikini binary-option bitcoin-profit bonus brides cannabis cash-advance
cash-prize cbd cheap click-here clickbait clone coin-flip credit-repair crypto-profit cum date-girl dating debt-relief
diet-pill discount-drug download-free drug earn-money erotic escorting exclusive-deal fast-cash free free-trial gamble
get-rich girl guaranteed hot hottie income-online instant-cash jackpot kamagra lingerie loan lottery lotto lucky-draw
lust make-money male-enhancement meds miracle-cure naked naughty no-deposit no-prescription nude oral outlet-store
online-pharmacy passive-income payday payday-loan penny-auction pharmacy pill playboy poker popup porn-free promo
quick-loan raffle refinance replica ringtone rolex sex sexual sexy shemales singles slim slot spin stake steroid strip
sugar-daddy sweepstake swingers taboo teen track tracker tracking unlimited-money unsecured vape weight-loss wager
webcam weed win winner work-from-home xrated
""".split()


def forms(term: str) -> tuple[str, str]:
    """A term and its plural."""
    return term, term + ("es" if term.endswith(("s", "x", "ch", "sh")) else "s")


STRICT = STRICT_TERMS
SOFT = [t for t in SOFT_TERMS if not {t} & {f for s in STRICT for f in forms(s)}]
# A strict term alone reaches the limit; soft terms do from this many.
SOFT_LIMIT = 2


@lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...], limit: int):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for weight, terms in ((1, soft), (limit, strict)):
        for term in terms:
            for form in forms(term):
                machine.add_word(form, (form, term, weight))
    machine.make_automaton()
    return machine


_EDGE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def weight_of(url: str, machine) -> int:
    """Sum of the weights of the distinct terms of a lower-case URL that
    stand alone."""
    found = {}
    for end, (form, term, weight) in machine.iter(url):
        before, after = end - len(form), end + 1
        if (before < 0 or url[before] not in _EDGE) and (after >= len(url) or url[after] not in _EDGE):
            found[term] = weight
    return sum(found.values())


def vocabulary_weight(url: Column, strict=tuple(STRICT), soft=tuple(SOFT), limit: int = SOFT_LIMIT) -> Column:
    """Weight of a lower-case URL; null URLs weigh nothing."""
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("long")
    def weigh(urls: pd.Series) -> pd.Series:
        machine = _automaton(strict, soft, limit)
        return urls.map(lambda u: 0 if u is None else weight_of(u, machine)).astype("int64")

    return weigh(url)


def judge_urls(df: DataFrame, url: str = "url", rules=RULES, strict=STRICT, soft=SOFT,
               limit: int = SOFT_LIMIT) -> DataFrame:
    """``df`` with host, path, rule and verdict (columns of these names are
    replaced)."""
    part = lambda i: F.coalesce(F.regexp_extract(F.col(url), r"://([^/?#]*)([^?#]*)", i), F.lit(""))
    df = df.withColumn("host", ascii_lower(part(1))).withColumn("path", part(2))
    host, path = F.col("host"), F.col("path")
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the longest is asked first
        rule = F.when(fits(h, p), F.lit(h + p)).otherwise(rule)
        action = F.when(fits(h, p), F.lit(act)).otherwise(action)
    weight = vocabulary_weight(ascii_lower(F.col(url)), strict, soft, limit)
    by_words = F.when(weight >= limit, "block").otherwise("allow")
    return df.withColumn("rule", rule).withColumn("verdict", F.coalesce(action, by_words))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def _terms_sql(terms: list[str]) -> str:
    return " + ".join(f"regexp_matches(u, '(^|[^a-z0-9])({'|'.join(forms(t))})($|[^a-z0-9])')::INT" for t in terms)


ORACLE = f"""
WITH s AS (SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
                  translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
v AS (SELECT *, '.' || host AS dotted,
             {SOFT_LIMIT} * ({_terms_sql(STRICT)}) + ({_terms_sql(SOFT)}) AS weight FROM s),
r AS (SELECT *, CASE WHEN dotted LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN dotted LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN dotted LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN dotted LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM v)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN weight >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
