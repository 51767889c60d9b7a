"""Small dimension tables authored by hand.

Each table has a fixed, proven size bound (it is a literal in this file), so
joining it with ``broadcast`` is always safe, whatever the size of the fact
side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Stopwords per language: common function words of each language (public
# knowledge; shorter than the lists the original tool loads, see README).
STOPWORDS = {
    "en": """a about after all also an and any are as at be been but by can could did do does
             for from had has have he her his how i if in into is it its more no not of on one
             or our out she so some than that the their them then there these they this to up
             was we were what when which who will with would you your""",
    "de": """aber alle als am an auch auf aus bei bin bis da das dass dem den der des die doch
             du durch ein eine einem einen einer er es für hat ich im in ist ja kein mit nach
             nicht noch nur oder sich sie sind so um und uns von vor war was wie wir zu zum zur""",
    "fr": """au aux avec ce ces cette dans de des du elle en est et était été il ils je la le
             les leur mais me même ne nous on ou par pas pour qu que qui sa se ses son sont sur
             ta te tu un une vous""",
    "es": """al como con cuando de del el ella en entre es esta está este fue ha hay la las le
             lo los me mi muy más no nos para pero por que se sin sobre son su sus también te
             tu un una uno ya yo""",
    "it": """ai al alla anche che chi ci come con cosa da dal della di dove e è era gli ha ho il
             in io la le lei lo loro lui ma mi nel nella noi non o per perché più quando questa
             questo se si sono su sul ti tu un una voi""",
    "nl": """aan als bij dan dat de deze die dit doen door een en er geen had heb heeft het hij hoe
             ik in is je kan maar me met mijn naar niet nog nu of om onder ook op over te tot uit
             van veel voor waar wat we wel werd wie wij ze zij zijn zo zou""",
    "pt": """ao aos as com como da das de dela dele do dos e ela ele em entre era essa esse esta
             este eu foi isso isto já lhe mais mas me mesmo minha muito na não nas nem no nos nós
             o os ou para pela pelo por que se sem ser seu sua são também te um uma você""",
}
DEFAULT_LANG = "en"
LANGS = sorted(STOPWORDS)

# ISO 3166-1 alpha-2 -> alpha-3 for the codes of the test tables (``iso_df`` has all). "UK" is not
# an ISO alpha-2 code (the kingdom is "GB"), so it deliberately has no entry.
ISO_ALPHA2_TO_ALPHA3 = {
    "AR": "ARG", "BE": "BEL", "BR": "BRA", "CA": "CAN", "CH": "CHE", "CN": "CHN",
    "DE": "DEU", "DZ": "DZA", "EG": "EGY", "ES": "ESP", "ET": "ETH", "FR": "FRA",
    "GB": "GBR", "ID": "IDN", "IN": "IND", "IQ": "IRQ", "IR": "IRN", "IT": "ITA",
    "JO": "JOR", "JP": "JPN", "KE": "KEN", "MA": "MAR", "MZ": "MOZ", "NL": "NLD",
    "PE": "PER", "RO": "ROU", "RU": "RUS", "SA": "SAU", "US": "USA", "VN": "VNM",
}

# Country code of each TPC-H nation key (spec order ALGERIA .. UNITED STATES).
# The kingdom is stamped "UK", the way the metadata collector labels it.
TPCH_NATION_CODES = ["DZ", "AR", "BR", "CA", "EG", "ET", "FR", "DE", "IN", "ID", "IR", "IQ", "JP",
                     "JO", "KE", "MA", "MZ", "PE", "CN", "RO", "SA", "VN", "RU", "UK", "US"]

# Collector grid and the workbook's selections.
COLLECTOR_CATEGORIES = ["music", "comedy", "sports", "dance", "beauty", "fashion", "food",
                        "pets", "travel", "education", "fitness", "diy", "gaming", "tech",
                        "entertainment", "lifehacks", "art", "memes", "automotive"]
WORKBOOK_REGION_SET = ["ES"]
WORKBOOK_REGION_LABEL = "small-region but high engagement"
WORKBOOK_EXCLUDED_REGIONS = ["UKIT"]
WORKBOOK_MODALITIES = ["caption", "music"]
# ---------------------------------------------------------------------------


def stopword_rows() -> list[tuple[str, str]]:
    return [(lang, w) for lang, words in STOPWORDS.items() for w in words.split()]


def _local(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """A literal table as a JVM-side local relation (no Python RDD, no Python
    workers at execution), hinted for broadcast: its size is fixed by this file."""
    return F.broadcast(spark.sql(f"SELECT * FROM {sql_values(rows, names)}"))


def stopwords_df(spark: SparkSession) -> DataFrame:
    """(lang, word); a few hundred rows."""
    return _local(spark, stopword_rows(), ["lang", "word"])


def stopword_langs_df(spark: SparkSession) -> DataFrame:
    """(word, sw_langs): one row per word with the languages it is a stopword of."""
    langs: dict[str, list[str]] = {}
    for lang, w in stopword_rows():
        langs.setdefault(w, []).append(lang)
    return _local(spark, sorted((w, sorted(ls)) for w, ls in langs.items()), ["word", "sw_langs"])


def iso_df(spark: SparkSession) -> DataFrame:
    """Every ISO 3166-1 country, alpha-2 and alpha-3, as the JVM's locale data has them (about 250)."""
    locale = spark.sparkContext._jvm.java.util.Locale
    codes = sorted((c, locale("", c).getISO3Country()) for c in locale.getISOCountries())
    return _local(spark, codes, ["alpha2", "alpha3"])


def nation_codes_df(spark: SparkSession) -> DataFrame:
    return _local(spark, list(enumerate(TPCH_NATION_CODES)), ["nationkey", "code"])


def sql_values(rows, names: list[str], alias: str = "t") -> str:
    """The same rows as an SQL VALUES list (used by the DuckDB oracle)."""
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, (list, tuple)):
            return "array(" + ", ".join(lit(x) for x in v) + ")"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(names)})"
