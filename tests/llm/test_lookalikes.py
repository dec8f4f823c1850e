"""Texts that look the same, against a brute-force grouping."""

import random
import unicodedata

from paperloom.llm import lookalikes as L
from paperloom.llm import queries

KIND = "field_name string, id bigint, text string, form string, spelling string, _clean string"


def frame(spark, rows):
    return spark.createDataFrame([(f, i, t, "extra", "extra", "extra") for f, i, t in rows], KIND)


def pairs(spark, rows):
    forms = L.repair_texts(frame(spark, rows), ["field_name", "id"], "text")
    few, many = (sorted(map(tuple, L.same_look_pairs(forms, "field_name", "id", "text", block=7, most=most).distinct().collect())) for most in (L.HOT, 2))
    assert few == many
    return few


def brute(rows):
    out = set()
    for f, i, t in rows:
        for g, j, u in rows:
            if f == g and i < j and t and u and t != u and L.visible(t) == L.visible(u):
                out.add((f, i, j))
    return sorted(out)


def disguise(rng, text):
    wide = {chr(c - 0xFEE0): chr(c) for c in range(0xFF01, 0xFF5F)}
    back = {}
    for a, b in L.LOOKALIKES.items():
        back.setdefault(b, []).append(a)
    out = ""
    for c in text:
        k = rng.random()
        if k < 0.1 and c in wide:
            out += wide[c]
        elif k < 0.2 and c in back:
            out += rng.choice(back[c])
        elif k < 0.25:
            out += c + chr(0x200B)
        elif c == " " and k < 0.6:
            out += chr(rng.choice([0xA0, 0x2009, 0x202F]))
        else:
            out += c
    return unicodedata.normalize(rng.choice(["NFC", "NFD"]), out).replace("fi", "ﬁ" if rng.random() < 0.5 else "fi")


def test_same_look_differs_only_in_characters():
    equal = ["office é", "oﬃce é", "ｏffice é", "оffice é", "off" + chr(0xAD) + "ice" + chr(0xA0) + "é", "office e" + chr(0x301)]
    assert len({L.visible(t) for t in equal}) == 1
    different = ["m2", "m²", "Me", "me", "mé", "a b", "ab", "a-b", "a.b", "a–b", "Ωm", "Om", "Δ", "A", "дом", "dom"]
    assert len({L.visible(t) for t in different}) == len(different)


def test_repair_prefers_the_corpus(spark):
    rows = [("f", 1, "the Склад door"), ("f", 2, "the Cклад door"), ("f", 3, "аn оffice"), ("f", 4, "an office"), ("f", 5, "ѕhут")]
    got = {r["id"]: r["form"] for r in L.repair_texts(frame(spark, rows), ["field_name", "id"], "text").collect()}
    assert got == {1: "the Склад door", 2: "the Склад door", 3: "an office", 4: "an office", 5: "shyт"}


def test_scripts_of_texts_decide_on_words_in_one_script(spark):
    rows = [("f", 1, "дом сор вода"), ("f", 2, "the сор stands"), ("f", 3, "a cop"), ("f", 4, "the cор is mixed"), ("f", 5, "Москвa"), ("f", 6, "Москва")]
    got = {r["id"]: (r["form"], r["look"]) for r in L.repair_texts(frame(spark, rows), ["field_name", "id"], "text").collect()}
    assert got[1][0] == "дом сор вода" and got[2][0] == "the cop stands"  # a Cyrillic text keeps its word
    assert got[4][0] == "the сор is mixed" and got[4][1] == L.visible("the cop is mixed")  # most letters are Cyrillic, and the word exists
    assert got[5] == got[6] and got[6][0] == "Москва"


def test_dominant_script_of_a_token():
    assert L.in_dominant_script("оffice") == "office" and L.in_dominant_script("Cклад") == "Склад"
    assert L.in_dominant_script("office") is None and L.in_dominant_script("сор") is None and L.in_dominant_script("дomzб") is None


def test_characters_of_unicode_properties():
    gone = [0x202A, 0x202E, 0x2066, 0x2069, 0xFE00, 0xFE0F, 0x200B, 0xAD, 0x3164, 0xE0101]
    assert all(L.visible("a" + chr(c) + "b") == "ab" for c in gone)
    assert all(L.visible("a" + chr(c) + "b") == "a b" for c in (0x85, 0x2028, 0x2029, 0xA0, 0x3000, 0x1680, 0x0D))
    assert L.visible("a" + chr(0x2012) + "b") == "a-b" and L.visible("￡￠￥") == "£¢¥" and L.visible("a\nb") == "a\nb"


def test_dominant_script():
    assert L.dominant_script("оffice") == ("latin", True) and L.dominant_script("Cклад") == ("cyrillic", True)
    assert L.dominant_script("12") == ("", False) and L.dominant_script("Тһе") == ("cyrillic", False)


def test_pairs_match_brute_force_with_a_hot_text(spark):
    rng = random.Random(7)
    words = ["office", "policy", "Malmö", "access", "São", "unit-7", "m²", "the", "Ａ", "Склад"]
    base = [" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(25)]
    rows = []
    for k in range(260):
        text = "shared stock phrase" if k % 3 == 0 else rng.choice(base)
        rows.append((rng.choice(["f", "g"]), k, disguise(rng, text) if rng.random() < 0.35 else text))
    rows += [("f", 900, None), ("f", 901, ""), ("f", 902, " "), ("f", 903, chr(0xA0)), ("f", 904, "x" * 60_000), ("f", 905, "ｘ" + "x" * 59_999)]
    assert pairs(spark, rows + rows[:40]) == brute(rows)


def test_empty_table(spark):
    assert pairs(spark, [("f", 1, "x")])[:1] == []
    forms = L.repair_texts(frame(spark, [("f", 1, "x")]).where("false"), ["field_name", "id"], "text")
    assert L.same_look_pairs(forms, "field_name", "id", "text").count() == 0


def test_query_columns(spark, small):
    assert queries.p1_found(spark, small).dtypes == [("field_name", "string"), ("id_1", "bigint"), ("id_2", "bigint")]
