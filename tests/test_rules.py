"""Cleaning and field rules on edge cases."""

import pytest

from tasador.functions import fields, rules, text

ONE = "a string"
TWO = "a string, b string"
THREE = "a string, b string, c string"

CASES = [
    (text.fold_accents, ONE, [("Híbrido ñ",), ("straße œ",), ("plain",), (None,), ("e\u0301",)], ["Hibrido n", "strasse oe", "plain", None, "e"]),
    (text.capitalise, ONE, [("mercedes-BENZ c",), ("",), (None,)], ["Mercedes-benz c", "", None]),
    (text.strip, ONE, [("\xa0 a b\n",), ("",)], ["a b", ""]),
    (text.number, ONE, [("1d",), ("1e2",), (" 12.5 ",), ("",), ("abc",), (None,)], [None, 100.0, 12.5, None, None, None]),
    (rules.brand_prep, ONE, [("Mercedes-benz",), ("ALFA",)], ["Mercedes", "Alfa"]),
    (rules.brand_digit, ONE, [("9bad",), ("",), ("Audi",), (None,)], [None, None, "Audi", None]),
    (
        lambda a: rules.fuel(rules.fuel_plain(a)), ONE,
        [("Diésel",), ("Híbrido enchufable",), ("Gas",), ("eléctrico",), ("GLP",), ("gasolina ",), (None,)],
        ["DIESEL", "ELECTRICO/HIBRIDO", None, "ELECTRICO/HIBRIDO", "GLP", None, None],
    ),
    (
        lambda a: rules.gearbox(rules.gear_plain(a)), ONE,
        [("Manual",), (" Doble embrague ",), ("Automática",), ("manual",), (None,)],
        ["Manual", "Automático", None, None, None],
    ),
    (
        lambda a: rules.gearbox(rules.gear_plain(a), {"Automatica": "Automatico"}), ONE,
        [("Automática",), ("Manual",)], ["Automático", "Manual"],
    ),
    (rules.cv, ONE, [("115",), ("40",), ("85kW",), ("85k",), ("1600",), ("9",), ("w10",), (None,)], [115.0, 140.0, None, None, None, None, None, None]),
    (rules.price_text, ONE, [("12.500",), ("12.5",), ("900",), ("1.234.567",), (None,)], ["12.500", None, "900", None, None]),
    (rules.year_part, ONE, [("05/2019",), ("2019",), ("19",), (None,)], ["2019", "2019", "19", None]),
    (rules.year_length, ONE, [("2019",), ("19",), (None,)], ["2019", None, None]),
    (lambda a, b: rules.plugin_shift(a, b)[0], TWO, [("x enchufable", "2020 100"), ("x enchufable", None), ("2019", "5")], ["2020", "x enchufable", "2019"]),
    (lambda a, b: rules.plugin_shift(a, b)[1], TWO, [("x enchufable", "2020 100"), ("x enchufable", "2020"), ("2019", "5")], ["100", "2020", "5"]),
    (rules.model_default, TWO, [(None, "A3 tdi"), ("X", "y"), (None, None)], ["A3", "X", None]),
    (rules.alfa_model, TWO, [("Alfa", "Romeo Giulia"), ("Alfa", "Mito"), ("Audi", "A3 x")], ["Giulia", "Mito", "A3 x"]),
    (rules.family, ONE, [("CLASE A x",), ("A3 Sportback",), ("",)], ["CLASE A x", "A3", ""]),
    (lambda a, b, c: rules.land_family(a, b, c)[1], THREE, [("Land", "land", "vx"), ("Land", "land", "Hiace x"), ("Land", "land", None), ("A", "A", "x")], ["Land Cruiser", "Hiace", "land", "A"]),
    (rules.named_family, THREE, [("X", "range", "y"), ("X", "serie", "3 d"), ("X", "serie", None), ("Mercedes", "A", "x"), ("Audi", "A", "x")], ["Range Rover", "serie 3", "serie None", "Clase A", "A"]),
    (rules.new_family, TWO, [("Nuevo Ibiza", "Ibiza fr"), ("Nuevo", None)], ["Ibiza", "Nuevo"]),
    (rules.finish_append, TWO, [("A3", "Sportback tdi Quattro"), ("A3", None), (None, "Sportback")], ["A3 Sportback Quattro", "A3", None]),
    (rules.model_final, ONE, [("CEE'D",), ("SERIE 3",), ("ID.3",), ("UP!",), ("NUEVO",), ("|",), (" ",), ("C-HR X",), (None,)], ["CEED", "SERIE3", "ID3", "UP", None, None, None, "CHRX", None]),
    (rules.brand_final, ONE, [("VW",), ("ASTON",), ("DSAUTOMOBILES",), ("RENAULTX",), ("ABARTH!",), ("NOSESABE",), ("CITROËN",)], ["VOLKSWAGEN", "ASTONMARTIN", "DS", "RENAULT", None, None, "CITROËN"]),
    (rules.brand_eq_model, THREE, [("MINI", "MINI", "mini cooper"), ("MINI", "MINI", "one d"), ("MINI", "MINI", "MINI"), ("A", "B", "c")], ["COOPER", "ONE", "MINI", "B"]),
    (rules.brand_map, ONE, [("Hyundai motor",), ("Land",), ("Alfa",), ("Opel x",), ("Kia",)], ["Hyundai", "Land rover", "Alfa romeo", "Opel", "Kia"]),
    (rules.p_dot_kept, ONE, [("AP.E",), ("P.x",), ("A",)], [False, True, True]),
    (text.bag, ONE, [("A3 2.0 TDI (GTI ( x navi)",), ("",), ("  (2x b",)], ["A3 TDI (GTI ( NAVI)", "", ""]),
    (fields.power_in_brackets, ONE, [("85 kW (115 CV)",), ("85 kW",)], ["115", None]),
    (fields.power_last_line, ONE, [("a\n99 CV\n115 CV\nb",), ("a",)], ["115", None]),
    (fields.financed_by_second_price, ONE, [("4.500 9.900 €",), ("4.500 € 9.900 €",), ("4.500 €",)], ["FINANCIADO", "SIN FINANCIACIÓN", "SIN FINANCIACIÓN"]),
    (fields.title_model, ONE, [("BMW SERIE 3 - x 320d",), ("BMW SERIE",), ("Audi A3 x",)], ["SERIE 320d", "SERIE", "A3"]),
    (fields.middle_words, ONE, [("Nuevo Audi A3 x",), ("Audi x",), ("Audi",)], ["Audi A3", "", ""]),
    (fields.gear_market, ONE, [("S tronic",), ("MANUAL 6",), ("dsg",)], ["Automático", "Manual", None]),
]


@pytest.mark.parametrize("rule, schema, rows, want", CASES, ids=[str(i) for i in range(len(CASES))])
def test_rule(apply_rule, rule, schema, rows, want):
    assert apply_rule(rule, rows, schema) == want


def test_link_needs_every_operand(apply_rule):
    rows = [("http://x/audi", "Audi", "A3", "A3", "web"), ("http://x/audi", "Audi", None, "A3", "web"), ("http://x", "Audi", "A3", "A3", "web")]
    schema = "a string, b string, c string, d string, e string"
    assert apply_rule(rules.link_check, rows, schema) == ["http://x/audi", None, None]


def test_labels_and_keys(apply_rule):
    page = "Marca:\n Audi \nAño Desde:\n2019\nFin:"
    found = lambda t: text.tokens(t, "\n")
    twice = "Marca:\nAudi\nMarca:\nSeat"
    assert apply_rule(lambda t: fields.labelled(found(t), "Marca:"), [(page,), ("x",), (twice,)], ONE) == ["Audi", None, "Audi"]
    assert apply_rule(lambda t: fields.labelled(found(t), "Fin:"), [(page,)], ONE) == [None]
    lines = "Precio contado: 1\nPrecio: 2\nAño : 2019"
    assert apply_rule(lambda t: fields.last_of(fields.key_lines(t), ["Precio", "Precio contado"]), [(lines,)], ONE) == ["2"]
    assert apply_rule(lambda t: fields.has_key(fields.key_lines(t), "k"), [("k: 1\nj: 0",), ("k",)], ONE) == [True, False]


def test_manual_comes_before_brand_names_of_automatics(apply_rule):
    rows = [("Manual S tronic",), ("Manual DSG",), ("S tronic",), ("DSG 7",), ("manual dsg",), ("Otro",), (None,)]
    assert apply_rule(fields.gear_by_name, rows, ONE) == ["Manual", "Manual", "Automática", "Automática", "Automática", "Otro", None]


def test_digest_is_sha224(apply_rule):
    import hashlib

    want = hashlib.sha224("AudiNoneA3".encode()).hexdigest()
    got = apply_rule(lambda a, b, c: rules.digest([a, b, c]), [("Audi", None, "A3")], THREE)
    assert got == [want]
    assert 0 <= apply_rule(lambda a: rules.surrogate(a), [(want,)], ONE)[0] < 9_999_999


def test_exact_key_tells_shifted_texts_apart(apply_rule):
    keys = apply_rule(lambda a, b: rules.exact_key([a, b]), [("ab", "c"), ("a", "bc"), (None, "c"), ("None", "c"), ("ab", "c")], TWO)
    assert len(set(map(bytes, keys))) == 4 and keys[0] == keys[4]
