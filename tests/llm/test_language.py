"""Languages on held-out documents, and the limits of what counts."""

import re

import numpy as np
import pytest

from paperloom.llm import language as L
from paperloom.session import table

EN = "The quick committee reviews every access request before the change is approved by the owner of the system."
DE = "Der Ausschuss prüft jede Anfrage, bevor die Änderung von der Leitung der Abteilung freigegeben werden kann."
FR = "Le comité examine chaque demande avant que la modification ne soit approuvée par le responsable du système."
ES = "El comité revisa cada solicitud antes de que el cambio sea aprobado por el responsable del sistema de archivos."
PT = "A comissão analisa cada pedido antes de a alteração ser aprovada pelo responsável do sistema de ficheiros."
NL = "De commissie beoordeelt elk verzoek voordat de wijziging door de eigenaar van het systeem wordt goedgekeurd."
OWN = dict(zip(L.LANGUAGES, (EN, DE, FR, ES, PT, NL), strict=True))


@pytest.fixture(scope="module")
def detector():
    rows = [(lang, "\n".join(text.replace("system", f"system {k}") for _ in range(2))) for lang, text in OWN.items() for k in range(6)]
    return L.fit([*rows, *(("de", EN) for _ in range(2))])  # two labels are wrong


def test_lines_documents_and_rejection(spark, detector):
    docs = [
        (1, EN, "en"), (2, EN, "ENGLISH"), (3, EN, "de"), (4, EN, None), (5, f"{EN}\n{EN}\n{DE}\nshort\n{NL}", "en-GB"), (6, None, "en"), (7, "", "en"), (8, "  \n \n", "en"),
        (9, "sha: " + "QX7K9ZP2" * 40, "en"), (10, "AC-1.001 | AC-2.002\n12\t13\t14", "en"), (11, "Проверка журналов проводится ежемесячно в соответствии с планом отдела.", "en"), (12, f"{FR}\n{FR}\n{FR[:30]}\n{EN[:38]}", "fr"),
        (13, f"{ES} " * 400, "pt"), (14, PT, "por"), (14, PT, "por"),
    ]
    df = spark.createDataFrame([(*d, "x", 0.5) for d in docs], "doc_id bigint, text string, lang string, label_lang string, confidence double")
    got = {tuple(r) for r in L.found_languages(L.detect_languages(df, detector)).collect()}
    assert got == {(3, -1, "en"), (4, -1, "en"), (5, 2, "de"), (5, 4, "nl"), (13, -1, "es")}
    every = L.detect_languages(df, detector)
    assert every.where("doc_id in (6, 7, 8, 9, 10, 11)").count() == 0
    assert all(0 < r["confidence"] <= 1 for r in every.collect())
    assert L.detect_languages(df.where("false"), detector).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("EN",), (" en-US ",), ("pt_BR",), ("deu",), ("Dutch",), ("unk",), ("",), (" ",), (None,), ("und",)], "lang string")
    assert [r[0] for r in df.select(L.label_language(df["lang"])).collect()] == ["en", "en", "pt", "de", "nl", None, None, None, None, None]


def test_probabilities_sum_to_less_than_one(detector):
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèêçãõñáíóú_"
    words = ["der", "the", "no"]
    for w in words:
        base = detector.models.score([w])
        assert np.isfinite(base).all() and (base < 0).all()
    # every one-letter word: the sum over letters of p(letter | start) stays below 1
    one = np.exp(detector.models.score(list(letters)))
    assert (one.sum(axis=0) <= 1.0 + 1e-5).all()


def test_held_out_accuracy(spark, small):
    docs = table(spark, small, "documents")
    tool = L.fit(L.sample(docs, 20))
    taught = {t for _, t in L.sample(docs, 20)}
    markers = {"en": r"\b(the|shall|must)\b", "de": r"\b(der|die|muss)\b", "fr": r"\b(doit|les|des)\b", "es": r"\b(debe|los|las)\b", "pt": r"\b(deve|os|da)\b", "nl": r"\b(het|moet|van)\b"}
    lines = [x for r in docs.select("text").collect() if r["text"] and r["text"][: L.SAMPLE_CHARS] not in taught for x in r["text"].split("\n") if len(re.findall("[^\\W\\d_]", x)) >= 80]
    expect = [max(markers, key=lambda k: len(re.findall(markers[k], x.lower()))) for x in lines]
    found = tool.lines(lines)[0]
    right = sum(k >= 0 and L.LANGUAGES[k] == e for k, e in zip(found, expect, strict=True))
    assert len(lines) > 100 and right / len(lines) > 0.97
