"""Text that looks the same but differs in its characters, brought to one form.

The skeleton of a text is: decomposed, invisible characters dropped, every character replaced by the prototype it
looks like, decomposed again. Texts with one skeleton look alike. The clean form is what is stored instead of an
original: ordinary width, ordinary spaces, accents joined to their letter, and look-alike letters replaced by their
prototypes only inside words that mix scripts, so that a word wholly in another script stays as it is.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts and the Latin letter each looks like.
GREEK = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX αa ιi κk νv οo ρp υu χx γy ϲc ϳj ϹC ͿJ"
CYRILLIC = "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT ХX ҮY УY ԌG ԚQ ԜW аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ӏl үy вb кk мm нn тt гr ѵv ԍg"
OTHER = "ՍU ՏS ՕO աw հh ոn սu օo ցg ҽe ɑa ɡg ɩi ıi ʏY ᴄc ᴏo ᴠv ᴡw ᴢz ᎪA ᏴB ᏟC ᎬE ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᏒR ᏚS ᎢT ᏙV ᏔW ᏃZ ⲞO ⲟo ⲢP ⲣp ⲤC ⲥc"
PROTOTYPE = {p[0]: p[1] for p in f"{GREEK} {CYRILLIC} {OTHER}".split()}
#: Scripts whose letters are taken for one another.
ALIKE = ("LATIN", "GREEK", "CYRILLIC", "ARMENIAN", "CHEROKEE", "COPTIC")
#: Ranges of signs that stand for ideographs, letters or digits although they are no letters by category: radicals, enclosed forms.
SIGNS = ((0x2E80, 0x2FDF), (0x2460, 0x24FF), (0x3200, 0x33FF), (0x1F100, 0x1F2FF))
#: Characters that cannot be seen though their category is not Cf.
UNSEEN = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, 0x2800, *range(0xFE00, 0xFE10), *range(0x180B, 0x180F), *range(0xE0100, 0xE01F0)}
SPACES = ("Zs", "Zl", "Zp")
#: Java pattern of texts that need a look: anything but ASCII, composed Latin letters, ideographs and typographic marks; compatibility forms among them are left out.
PLAIN = r"^[\x20-\x7E\x{A1}-\x{A9}\x{AB}\x{AC}\x{AE}-\x{B1}\x{B4}\x{B6}-\x{B8}\x{BB}\x{BF}-\x{131}\x{134}-\x{13E}\x{141}-\x{148}\x{14A}-\x{17E}\x{2010}-\x{2027}\x{2030}-\x{203A}\x{3001}-\x{3035}\x{3037}\x{303B}-\x{303F}\x{4E00}-\x{9FFF}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}]*\z"


@lru_cache(65536)
def script(ch: str) -> str:
    """The look-alike script of a letter, else an empty string."""
    if not ch.isalpha():
        return ""
    first = unicodedata.name(ch, "").partition(" ")[0]
    return first if first in ALIKE else ""


@lru_cache(65536)
def visible(ch: str) -> str:
    """A character as it is stored in clean text: itself, its ordinary form, a space, or nothing if it cannot be seen."""
    kind, code = unicodedata.category(ch), ord(ch)
    if kind in SPACES or ch in "\t\x0b\x0c\x85":
        return " "
    if kind == "Cf" or code in UNSEEN or (kind == "Cc" and ch not in "\n\r"):
        return ""
    plain = unicodedata.normalize("NFKC", ch)
    if plain != ch and (kind[0] in "LN" or any(a <= code <= b for a, b in SIGNS)):
        return plain
    return ch


_WORD = re.compile(r"[^\W\d_][^\W_]*")


def _one_script(word: re.Match) -> str:
    text = word.group()
    found = {script(c) for c in text} - {""}
    if len(found) < 2:
        return text
    # a word that mixes scripts becomes its skeleton's letters, if these are of one script
    alike = unicodedata.normalize("NFC", skeleton(text) or "")
    if len({script(c) for c in alike} - {""}) < 2:
        return alike
    return text if "LATIN" not in found else "".join(c if script(c) in ("LATIN", "") else PROTOTYPE.get(c, c) for c in text)


def clean(text: str | None) -> str | None:
    """The consistent form; null stays null."""
    if text is None or text.isascii() and text.isprintable():
        return text
    return _WORD.sub(_one_script, unicodedata.normalize("NFC", "".join(map(visible, text))))


def mixed(text: str) -> bool:
    """Whether a word holds letters of two look-alike scripts."""
    return any(len({script(c) for c in w} - {""}) > 1 for w in _WORD.findall(text))


def skeleton(text: str | None) -> str | None:
    """Equal for texts that look alike; case counts. Null stays null."""
    if text is None or text.isascii() and text.isprintable():
        return text
    seen = unicodedata.normalize("NFD", "".join(map(visible, unicodedata.normalize("NFD", text))))
    return unicodedata.normalize("NFD", "".join(PROTOTYPE.get(c, c) for c in seen))


def needs(text: str | None) -> bool:
    """Whether a text differs from the form its skeleton gives it, or has an accent that joins no letter, or a word of two scripts that no prototype brings to one."""
    if text is None or text.isascii() and text.isprintable():
        return False
    return clean(text) != text or any("\u0300" <= c <= "\u036f" for c in text) or mixed(text)


def _forms(values: pd.Series) -> pd.DataFrame:
    known: dict = {}
    for v in values:
        if v not in known:
            known[v] = (clean(v), skeleton(v), needs(v))
    return pd.DataFrame([known[v] for v in values], columns=["clean", "skeleton", "needed"])


def with_forms(df: DataFrame, value: str) -> DataFrame:
    """Adds ``clean``, ``skeleton`` and ``needed``. Plain values never leave the JVM; nulls give null, null, false.

    ``needed``: the value differs from the form made of its skeleton, that is, it has width or compatibility forms of letters, digits or ideographs, accents apart from their
    letter, spaces other than U+0020, invisible characters, or a word of two look-alike scripts. Equal values give equal forms.
    """
    forms_of = F.pandas_udf(_forms, "struct<clean: string, skeleton: string, needed: boolean>")
    plain = F.col(value).isNull() | F.col(value).rlike(PLAIN)
    odd = df.filter(~plain).withColumn("_f", forms_of(value)).select(*df.columns, "_f.clean", "_f.skeleton", "_f.needed")
    # a plain value may hold composed letters, which the skeleton takes apart
    bare = F.col(value).isNull() | F.col(value).rlike(r"^[\x20-\x7E]*\z")
    easy = df.filter(plain & bare).select("*", F.col(value).alias("clean"), F.col(value).alias("skeleton"), F.lit(False).alias("needed"))
    rest = df.filter(plain & ~bare).withColumn("_f", forms_of(value)).select(*df.columns, "_f.clean", "_f.skeleton", F.lit(False).alias("needed"))
    return odd.unionByName(easy).unionByName(rest)


def fields_long(tables: list[tuple[DataFrame, str, str, list[str]]]) -> DataFrame:
    """table_name, row_key, field, value of (table, name, key column, fields); columns of other names are left out."""
    out: DataFrame | None = None
    for df, name, key, fields in tables:
        one = df.select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("row_key"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("v")).select("table_name", "row_key", "v.*")
        out = one if out is None else out.unionByName(one)
    return out


def look_alikes(values: DataFrame, value: str = "value") -> DataFrame:
    """Groups of different originals of one skeleton: skeleton, forms (different originals), rows, clean (of the smallest original). Partial sums by original come first, so a value that fills a third of the rows is one row a task."""
    each = with_forms(values.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("rows")), value)
    return each.groupBy("skeleton").agg(F.count("*").alias("forms"), F.sum("rows").alias("rows"), F.min_by("clean", value).alias("clean")).filter("forms > 1")
