from __future__ import annotations

import random

import pytest

from lessonlake.llm import chars
from lessonlake.llm.chars import LookalikeModel, repair_encoding, word_bigrams

TEXT = "Según el relato, la niñez lee «así»; ¿qué enseña el camino? — ½ hora, 2.º día…"


def broken(text, encoding):
    """UTF-8 read in an encoding; bytes without a character pass through."""
    out = []
    for b in text.encode("utf-8"):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251"])
def test_round_trips(encoding):
    out, fixed, lost, ops = repair_encoding(broken(TEXT, encoding))
    assert out == TEXT and fixed and not lost and ops


def test_double_decoding_and_other_scripts():
    assert repair_encoding(broken(broken(TEXT, "cp1252"), "cp1252"))[0] == TEXT
    assert repair_encoding(broken("El término λόγος y שלום, así", "cp1252"))[0] == "El término λόγος y שלום, así"
    assert repair_encoding("ni&ntilde;ez y ma&ntilde;ana")[0] == "niñez y mañana"


@pytest.mark.parametrize("text", [TEXT, "SÃO MATEUS", "ÂNIMO, IRMÃ", "ORAÇÃO DA MANHÃ", "AMANHÃ À NOITE", "TRADIÇÕES CRISTÃS", "nota² al pie, 25 °C", "término λόγος", "R&D, A & B", "¬°§¤ ¬ª·¬", "«CAFÉ»", "Ріedra y Сіudad"])
def test_ordinary_text_is_left_alone(text):
    out, fixed, lost, _ = repair_encoding(text)
    assert (out, fixed, lost) == (text, 0, 0)


def test_lost_characters_are_reported():
    assert repair_encoding("la oraci�n")[1:3] == (0, 1)
    assert repair_encoding("el capÃ?tulo de la oraciÃ³n")[1:3] == (1, 1)
    assert repair_encoding(None)[:3] == (None, 0, 0) and repair_encoding("")[:3] == ("", 0, 0)


@pytest.fixture(scope="module")
def model():
    pairs: dict[str, int] = {}
    for w in "según relato niñez camino principio término gracia pero misma sagrada escuela alumno maestro congregación λόγος χάρις ἀγάπη νόμος".split():
        word_bigrams(w, 50, pairs)
    return LookalikeModel(pairs)


@pytest.mark.parametrize(
    ("seen", "meant"),
    [("рero", "pero"), ("grасіа", "gracia"), ("ｃａｍｉｎｏ", "camino"), ("gra​cia", "gracia"), ("niñez", "niñez"), ("la misma gracia", "la misma gracia"), ("teórico‑práctico", "teórico-práctico"), ("ﬁrme", "firme"), ("misma﻿", "misma"), ("sagrαda", "sagrada"), ("１２:３", "12:3")],
)
def test_lookalikes(model, seen, meant):
    out, n = model.normalize(seen)
    assert out == meant and n > 0
    assert model.normalize(out) == (meant, 0)


@pytest.mark.parametrize("text", ["término λόγος", "χάρις y ἀγάπη", "חֶסֶד", "2.º 3.ª nota² ½", "“así” — ‘no’ …", "niñez", "SÃO", "©"])
def test_ordinary_characters_stay(model, text):
    assert model.normalize(text) == (text, 0)


def test_nulls_and_long_texts(model):
    assert model.normalize(None) == (None, 0) and model.normalize("") == ("", 0)
    rng = random.Random(1)
    long = " ".join(rng.choice(["рero", "gracia", "λόγος", "ｍｉｓｍａ"]) for _ in range(50_000))
    out, n = model.normalize(long)
    assert n > 0 and "р" not in out and "ｍ" not in out and len(out.split()) == 50_000


def spanish_model():
    words = "la canción nueva también enseñanza enseña señor oración corazón lección atención nación región misión visión camión según niño mañana pequeño común jardín razón comprensión sección función condición tradición"
    pairs = {}
    for w in words.split():
        chars.word_bigrams(w, 500, pairs)
    return chars.LookalikeModel(pairs)


@pytest.mark.parametrize("read", ["mac_roman", "cp437", "cp850", "cp1251"])
@pytest.mark.parametrize("word", ["canción", "también"])
def test_words_read_in_another_single_byte_encoding(read, word):
    wrong = f"la {word.encode('latin-1').decode(read)} nueva"
    out, fixed, lost, ops = chars.repair_encoding(wrong, spanish_model())
    assert out == f"la {word} nueva" and (fixed, lost) == (1, 0) and any(o.startswith(f"{read}>") for o in ops)


@pytest.mark.parametrize("text", ["façade and São Paulo", "muу bien", "sí—no", "3½ libros", "n.º 7", "Ação de graças", "θεός y Бог"])
def test_words_of_their_own_are_not_reread(text):
    assert chars.repair_encoding(text, spanish_model())[:3] == (text, 0, 0)
    assert chars.repair_encoding(text)[:3] == (text, 0, 0)


def test_lost_bytes_are_states_that_reach_no_text():
    assert chars.search_run("Ã³")[:2] == ("ó", ("cp1252>utf-8",)) and chars.search_run("�")[2] >= chars.LOST_COST
    assert chars.repair_encoding("canci�n")[1:3] == (0, 1) and chars.repair_encoding("canciÃ?n")[1:3] == (0, 1)
    assert chars.repair_encoding("¿QUÃ? DICE")[1:3] == (0, 0)  # a name with a question mark, as far as one can tell
    assert chars.repair_encoding("oraciÃ³n de QUÃ? DICE")[1:3] == (1, 1)  # beside a restored run it is a lost byte
    assert chars.repair_encoding("Ã‚Â¡" * 3 + "ya")[0].endswith("ya")


def test_one_search_finds_what_two_do():
    rng = random.Random(11)
    some = "abñáÑÉ¼½§²¢¬…“”™ﬁοа\u0301\xa0 \nÃ©"
    for _ in range(5000):
        text = "".join(rng.choices(some, k=rng.randint(1, 9)))
        assert bool(chars.STRANGE.search(text)) == bool(chars.UNUSUAL.search(text) or chars.SIGN_IN_WORD.search(text))


def test_normal_forms_of_several_kinds_at_once():
    model = LookalikeModel({})
    assert model.normalize("Así… ½ n.º “é”") == ("Así… ½ n.º “é”", 0)
    assert model.normalize("\ufb01n…\xa0ca\u200bsa \u2010 ma\u0301s\u2122 \uff41\u0301") == ("fin… casa - más™ á", 7)
    assert {x for c in "\u200b\xa0" for x in chars._kinds(c)} == {chars.IGNORABLE, chars.SPACES}
