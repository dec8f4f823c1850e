"""One form for texts that look the same but are stored in different characters.

A text is brought to one form in two steps. *Cleaning* needs the text alone: full-width forms, ligatures, blanks
and hyphens take their plain character, invisible characters go, accents are composed. *Repair* needs the corpus:
a token (run of letters and digits) that holds look-alike letters is replaced by a spelling that the corpus itself
uses. The script of each letter gives the dominant script of the token; a mixed token takes the spelling in one
script that looks like it, if the vocabulary (all tokens of the corpus in a single script) has one.

What that leaves has three further steps, which README measures. A mixed token without such a spelling takes the one
that the vocabulary has in another script, the Latin one first, else the Latin one. A token in one script alone is
left as it is, unless the rest of its text is in another one and the vocabulary has its Latin spelling (a lone
Cyrillic letter for "a"): a word of a Cyrillic text is never touched. Texts whose forms still look the same are
brought together by the *look* of the form, every look-alike letter as the Latin one.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import materialize

# Letters of other scripts that look like a Latin letter, each beside it.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТХЅІЈҮԌԚԜаеорсухѕіјѵһԁԛԝ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹονϲϳ" + "Օօ" + "ɡ",
        "ABEKMHOPCTXSIJYGQWaeopcyxsijvhdqw" + "ABEZHIKMNOPTYXCovcj" + "Oo" + "g",
        strict=True,
    )
)
# Characters that stand for one or more plain characters.
LIGATURES = {0xFB00: "ff", 0xFB01: "fi", 0xFB02: "fl", 0xFB03: "ffi", 0xFB04: "ffl", 0xFB05: "ſt", 0xFB06: "st", 0x0132: "IJ", 0x0133: "ij"}
SYMBOLS = {0x00B5: "μ", 0x2206: "Δ"}
# Hyphens that do not differ on the page, the figure dash among them; longer dashes and the minus do.
HYPHENS = (0x058A, 0x1806, 0x2010, 0x2011, 0x2012, 0x2043, 0xFE63, 0xFF0D)

# The rest follows from the Unicode properties. Invisible are format characters, variation selectors and the fillers and
# joiners that are no format characters; blanks are space separators and the controls that move on within or to a line,
# but for the line feed, which parts lines; wide and narrow forms stand for the character of usual width.
_PLACES = (*range(0x80, 0x10000), *range(0x1BCA0, 0x1BCA4), *range(0x1D173, 0x1D17B), *range(0xE0000, 0xE01F0))
INVISIBLE = tuple(a for a in _PLACES if unicodedata.category(chr(a)) == "Cf" or 0xFE00 <= a <= 0xFE0F or 0x180B <= a <= 0x180F or a >= 0xE0100 or a in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0))
BLANKS = (0x09, 0x0B, 0x0C, 0x0D, 0x85, *(a for a in _PLACES if unicodedata.category(chr(a)) in ("Zs", "Zl", "Zp")))
WIDE = {a: chr(int(d[1], 16)) for a in range(0xFF00, 0xFFEF) if len(d := unicodedata.decomposition(chr(a)).split()) == 2}

_CLEAN = {
    **WIDE, **LIGATURES, **SYMBOLS,
    **dict.fromkeys(BLANKS, " "), **dict.fromkeys(HYPHENS, "-"), **dict.fromkeys(INVISIBLE),
}
_FOREIGN = re.compile(f"[^{chr(0)}-{chr(0x24F)}]").search
_TOKEN = re.compile(rf"[\w{chr(0x300)}-{chr(0x36F)}]+")  # combining marks belong to their letter
_ASCII_TOKEN = re.compile(r"\w+")
_UNCLEAN = re.compile("[" + "".join(map(re.escape, map(chr, _CLEAN))) + "]")
_SIMILAR = re.compile("[" + "".join(LOOKALIKES) + "]")
_CLEANED = {chr(a): b or "" for a, b in _CLEAN.items()}
_LATIN_1_UNCLEAN = [chr(a) for a in _CLEAN if a <= 0xFF]


def is_plain(text: str) -> bool:
    """Whether a text of the first 256 characters has none that cleaning replaces: it is in its form already."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not any(c in text for c in _LATIN_1_UNCLEAN)


#: Keys of a join that are broadcast because they are the most frequent ones.
HOT = 10_000
#: Distinct tokens that a task holds before it hands them on.
VOCABULARY_BLOCK = 400_000


def _swept(text: str) -> str:
    return _UNCLEAN.sub(lambda m: _CLEANED[m[0]], text)


def clean(text: str) -> str:
    """The text with every character that stands for a plain one replaced by it, accents composed."""
    return text if is_plain(text) else unicodedata.normalize("NFC", _swept(text))


def latin(token: str) -> str:
    """The token with every look-alike letter replaced by the Latin letter that it looks like."""
    return unicodedata.normalize("NFC", _SIMILAR.sub(lambda m: LOOKALIKES[m[0]], unicodedata.normalize("NFD", token)))


def visible(text: str) -> str:
    """A text's form without the help of a corpus: equal for two texts exactly if they look the same."""
    return text if is_plain(text) else latin(_swept(text))


def script(letter: str) -> str:
    """Script of a letter, '' for digits and marks."""
    code = ord(letter)
    if not letter.isalpha():
        return ""
    if code <= 0x24F or 0x1E00 <= code <= 0x1EFF:
        return "latin"
    if 0x370 <= code <= 0x3FF or 0x1F00 <= code <= 0x1FFF:
        return "greek"
    if 0x400 <= code <= 0x52F:
        return "cyrillic"
    if 0x530 <= code <= 0x58F:
        return "armenian"
    return "other"


def dominant_script(token: str) -> tuple[str, bool]:
    """The script of most letters (the Latin one on a tie) and whether there are several."""
    seen = Counter(x for x in map(script, token) if x)
    if not seen:
        return "", False
    return max(seen, key=lambda k: (seen[k], k == "latin", k)), len(seen) > 1


def in_dominant_script(token: str) -> str | None:
    """A mixed token with its look-alikes in the script of most of its letters; None if it is not mixed or stays so."""
    dominant, mixed = dominant_script(token)
    if not mixed:
        return None
    if dominant == "latin":
        out = latin(token)
    else:
        plain = unicodedata.normalize("NFD", token)
        plain = "".join(c if script(c) in ("", dominant) else _LIKE.get(dominant, {}).get(LOOKALIKES.get(c, c), c) for c in plain)
        out = unicodedata.normalize("NFC", plain)
    return None if dominant_script(out)[1] else out


#: For each other script its letters by the Latin one that they look like.
_LIKE: dict[str, dict[str, str]] = {}
for _letter, _plain in LOOKALIKES.items():
    _LIKE.setdefault(script(_letter), {}).setdefault(_plain, _letter)


def _suspicious(token: str) -> bool:
    return bool(_FOREIGN(token)) and latin(token) != token


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(seen: Counter) -> pa.RecordBatch:
        form, token, single, odd, goal, main = [], [], [], [], [], []
        for t in seen:
            strange = _suspicious(t)
            form.append(latin(t) if strange else t)
            token.append(t)
            odd.append(strange)
            dominant, mixed = dominant_script(t) if strange else (None, False)
            single.append(not mixed)
            main.append(dominant)
            goal.append(in_dominant_script(t) if mixed else None)
        return pa.RecordBatch.from_arrays(
            [pa.array(form, pa.string()), pa.array(token, pa.string()), pa.array(single), pa.array(odd), pa.array(goal, pa.string()), pa.array(main, pa.string()), pa.array(seen.values(), pa.int64())],
            names=["form", "token", "single", "odd", "goal", "script", "n"],
        )

    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                if is_plain(text):
                    seen.update(_ASCII_TOKEN.findall(text))
                else:
                    seen.update(_TOKEN.findall(clean(text)))
        if len(seen) > VOCABULARY_BLOCK:
            yield rows(seen)
            seen = Counter()
    if seen:
        yield rows(seen)


#: What decided on a token's spelling: its dominant script and the vocabulary; the vocabulary or the Latin skeleton;
#: the vocabulary and the rest of the text.
NAMED, LEFT_OVER, ALONE = 1, 2, 3


def corpus_spellings(texts: DataFrame, text: str) -> DataFrame:
    """Rows (token, spelling, step, script, n) of each token with look-alikes that is to be spelled in another way.

    A mixed token takes its look-alikes from its dominant script if the vocabulary, all tokens of the corpus in one
    script, has the result (``NAMED``). Else it takes the Latin spelling if the vocabulary has it, else the most frequent
    one in a single script (ties: the greatest), else the Latin one (``LEFT_OVER``). A token in one script has a row if
    the vocabulary has its Latin spelling (``ALONE``: only where the text's script is another one than its
    own, ``script``). Tokens are counted within each task before they are shuffled, so a token in a third of all texts
    is one row per task; the spellings of one look are few.
    """
    counted = texts.select(text).mapInArrow(_vocabulary, "form string, token string, single boolean, odd boolean, goal string, script string, n bigint")
    per_token = counted.groupBy("form", "token", "single", "odd", "goal", "script").agg(F.sum("n").alias("n"))
    every = F.collect_list(F.struct("n", "token", "single", "odd", "goal", "script"))
    alike = per_token.groupBy("form").agg(F.bool_or(~F.col("odd")).alias("has_latin"), F.bool_or("odd").alias("any_odd"), every.alias("all")).where("any_odd")
    single = F.filter("all", lambda t: t["single"])
    best = F.when(F.col("has_latin"), F.col("form")).otherwise(F.coalesce(F.array_max(single)["token"], F.col("form")))
    rows = alike.select("form", "has_latin", best.alias("best"), F.transform(single, lambda t: t["token"]).alias("words"), F.explode(F.filter("all", lambda t: t["odd"])).alias("t"))
    named = F.col("t.goal").isNotNull() & F.array_contains("words", F.col("t.goal"))
    step = F.when(named, NAMED).when(~F.col("t.single"), LEFT_OVER).when(F.col("has_latin"), ALONE)
    spelling = F.when(named, F.col("t.goal")).when(~F.col("t.single"), F.col("best")).otherwise(F.col("form"))
    return rows.select("t.token", spelling.alias("spelling"), step.alias("step"), "t.script", "t.n").where("step is not null")


def _segments(text: str) -> list[dict] | None:
    """The cleaned text cut after every token with look-alikes: literal text, then the token."""
    if not _FOREIGN(text):
        return None
    out, at = [], 0
    for m in _TOKEN.finditer(text):
        if _suspicious(m[0]):
            out.append({"lit": text[at : m.start()], "token": m[0]})
            at = m.end()
    return [*out, {"lit": text[at:], "token": None}] if out else None


def _cleaned(odd: bool):
    """Rows with the text last to those with or without look-alikes, with the cleaned text, its pieces and its script."""
    kind = pa.list_(pa.struct([("lit", pa.string()), ("token", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = [x if x is None else clean(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            cut = [(x and _segments(x)) or None for x in plain]
            mine = [k for k, c in enumerate(cut) if (c is not None) == odd]
            columns = [pa.array([plain[k] for k in mine], pa.string()), *([pa.array([cut[k] for k in mine], kind), pa.array([dominant_script(plain[k])[0] for k in mine])] if odd else [])]
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(mine, pa.int64())).columns, *columns], names=[*batch.schema.names, "_clean", *(["_cut", "_script"] if odd else [])])

    return run


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([latin(x) for x in batch.column(batch.num_columns - 1).to_pylist()], pa.string())], names=[*batch.schema.names, "_look"])


def join_frequent(rows: DataFrame, table: DataFrame, keys: list[str], n: str, most: int = HOT) -> DataFrame:
    """``rows`` joined with ``table`` (unique ``keys``), where ``n`` says how many rows each key has about.

    The ``most`` most frequent keys are joined by a broadcast, whose size that bounds; any other key has at most one of
    ``most`` parts of the rows, so that no task gets more in the shuffle. Both frames should be written tables.
    """
    if table.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(table), keys)
    hot = F.broadcast(materialize(table.orderBy(F.desc(n), *keys).limit(most)))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(table.join(hot.select(*keys), keys, "left_anti"), keys)
    return rows.join(hot, keys).unionByName(cold)


def repair_texts(texts: DataFrame, keys: list[str], text: str, form: str = "form", look: str = "look") -> DataFrame:
    """(keys..., text, form, look): the one form of each text, by cleaning and script-aware repair, and the form's look.

    ``keys`` must name a text; repeated rows keep their repeats. Null stays null, an empty text stays empty; a text
    without look-alikes is cleaned within its task and never shuffled, and looks as its form. Other columns are dropped.
    """
    rows = texts.select(*keys, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    plain = rows.mapInArrow(_cleaned(False), f"{schema}, _clean string").select(*keys, F.col("_text").alias(text), F.col("_clean").alias(form), F.col("_clean").alias(look))
    odd = materialize(rows.mapInArrow(_cleaned(True), f"{schema}, _clean string, _cut array<struct<lit:string,token:string>>, _script string"))
    spellings = materialize(corpus_spellings(texts, text))
    tokens = odd.select(*keys, "_script", F.explode(F.array_distinct(F.transform("_cut", lambda s: s["token"]))).alias("token")).where("token is not null")
    known = join_frequent(tokens, spellings, ["token"], "n").where((F.col("step") != ALONE) | (F.col("script") != F.col("_script")))
    known = known.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("token", "spelling"))).alias("_known"))
    mended = F.array_join(F.transform("_cut", lambda s: F.concat(s["lit"], F.coalesce(F.try_element_at("_known", s["token"]), s["token"], F.lit("")))), "")
    joined = odd.join(known, keys, "left").select(*keys, "_text", mended.alias("_form")).mapInArrow(_folded, f"{schema}, _form string, _look string")
    return plain.unionByName(joined.select(*keys, F.col("_text").alias(text), F.col("_form").alias(form), F.col("_look").alias(look)))


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value.cast("binary")))


def same_look_pairs(forms: DataFrame, group: str, key: str, text: str, look: str = "look", block: int = 20_000, most: int = HOT) -> DataFrame:
    """Pairs (group, id_1, id_2), id_1 < id_2, of rows whose texts differ but have one look.

    Null and empty texts are in no pair. The rows of a look are grouped by stored text; the text with most rows is
    its hub, and only rows of other texts are joined with all rows of the look, so that the copies of one text,
    however many, are never paired with each other. Both sides of a look with many rows are cut into blocks of
    ``block`` rows. Digests of texts and looks are written once into the shared folder, so that the texts are repaired once.
    """
    rows = materialize(forms.where(F.length(text) > 0).select(group, F.col(key).cast("bigint").alias("id"), _digest(F.col(text)).alias("stored"), _digest(F.col(look)).alias("look")))
    counts = rows.groupBy(group, "look", "stored").agg(F.count(F.lit(1)).alias("n"))
    looks = counts.groupBy(group, "look").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"), F.max(F.struct("n", "stored")).alias("hub"))
    cut = lambda n: F.ceil(n / block).cast("int")
    looks = looks.where("kinds > 1").select(group, "look", F.col("hub.stored").alias("hub"), "total", cut(F.col("total")).alias("blocks"), cut(F.col("total") - F.col("hub.n")).alias("slices"))
    members = join_frequent(rows, materialize(looks), [group, "look"], "total", most)
    place = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    every = members.select(group, "look", F.col("id").alias("id_b"), F.col("stored").alias("stored_b"), (F.col("stored") == F.col("hub")).alias("hub_b"), place("blocks").alias("block"), each("slices").alias("slice"))
    minor = members.where(F.col("stored") != F.col("hub")).select(group, "look", F.col("id").alias("id_a"), F.col("stored").alias("stored_a"), place("slices").alias("slice"), each("blocks").alias("block"))
    pairs = minor.join(every, [group, "look", "block", "slice"]).where((F.col("stored_a") != F.col("stored_b")) & (F.col("hub_b") | (F.col("id_a") < F.col("id_b"))))
    return pairs.select(group, F.least("id_a", "id_b").alias("id_1"), F.greatest("id_a", "id_b").alias("id_2"))


def policy_texts(control_row: DataFrame, paragraph: DataFrame) -> DataFrame:
    """Rows (field_name, id, text) of the fields that problem 1 names; a row delivered twice counts once."""
    a = control_row.select(F.lit("control_description").alias("field_name"), F.col("row_id").alias("id"), F.col("control_description").alias("text"))
    b = paragraph.select(F.lit("accepted").alias("field_name"), F.col("para_id").alias("id"), F.col("accepted").alias("text"))
    return a.unionByName(b)
