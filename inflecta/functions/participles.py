"""Rules on the lines of participle tenses: arrays of (forme, participe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inflecta.dims import PARTICIPLE_FORMS
from inflecta.functions.text import once, squeeze, strip

COMPOUND_FORMS = [f"compound_{form}" for form in PARTICIPLE_FORMS]


def _entries(pairs: list[tuple[str, Column]]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("forme"), value.alias("participe")) for name, value in pairs])


def _none() -> Column:
    return F.array().cast("array<struct<forme:string,participe:string>>")


def _parts(text: Column) -> Column:
    return F.transform(F.split(text, ","), strip)


def _words(text: Column) -> Column:
    return F.split(strip(text), r"(?U)\s+")


def _but_last(text: Column) -> Column:
    words = _words(text)
    return F.array_join(F.slice(words, 1, F.size(words) - 1), " ")


def _reform(rectifs: Column, n: int) -> Column:
    return strip(F.get(rectifs, n))


def _with_reform(form: Column, separator: str, reform: Column) -> Column:
    return F.concat(form, F.coalesce(F.concat(F.lit(separator), reform), F.lit("")))


def present(lines: Column) -> Column:
    """Active or pronominal present: the first cell that has text."""
    texts = F.transform(lines, lambda line: squeeze(line["full"]))
    first = F.get(F.filter(texts, lambda text: text != ""), 0)
    return F.when(first.isNotNull(), _entries([("present", first)])).otherwise(_none())


def passive_present(lines: Column) -> Column:
    """Passive present: four forms that share the words before the first; fewer stay one text."""

    def of_line(line: Column) -> Column:
        return once(F.struct(line.alias("line"), _parts(squeeze(line["main"])).alias("forms")), of_forms)

    def of_forms(known: Column) -> Column:
        return once(F.struct(known["line"].alias("line"), known["forms"].alias("forms"), _but_last(F.get(known["forms"], 0)).alias("prefix")), entries)

    def entries(known: Column) -> Column:
        line, forms, prefix = known["line"], known["forms"], known["prefix"]

        def full(n: int) -> Column:
            return F.when(prefix != "", F.concat(prefix, F.lit(" "), F.get(forms, n))).otherwise(F.get(forms, n))

        four = _entries(
            [
                ("present_sm", _with_reform(F.get(forms, 0), " ou ", _reform(line["rectifs"], 0))),
                ("present_sf", full(1)),
                ("present_pm", _with_reform(full(2), " ou ", _reform(line["rectifs"], 1))),
                ("present_pf", full(3)),
            ]
        )
        text = squeeze(line["full"])
        return (
            F.when(line.isNull(), _none())
            .when(F.size(forms) >= 4, four)
            .when(text != "", _entries([("present", text)]))
            .otherwise(_none())
        )

    return once(F.get(F.filter(lines, lambda x: squeeze(x["main"]) != ""), 0), of_line)


def _compound(compose: Column, reforms: Column) -> Column:
    """Compound past: four forms that share the auxiliary, or one text for all four; both columns are read often."""

    def of_parts(known: Column) -> Column:
        return once(F.struct(known.alias("parts"), F.concat(_but_last(F.get(known, 0)), F.lit(" ")).alias("aux")), entries)

    def entries(known: Column) -> Column:
        parts, aux = known["parts"], known["aux"]

        def reformed(form: Column, n: int) -> Column:
            return _with_reform(form, "; ", F.concat(aux, F.get(reforms, n)))

        four = _entries(
            [
                ("passe_compound_sm", reformed(F.get(parts, 0), 0)),
                ("passe_compound_sf", F.concat(aux, F.get(parts, 1))),
                ("passe_compound_pm", reformed(F.concat(aux, F.get(parts, 2)), 1)),
                ("passe_compound_pf", F.concat(aux, F.get(parts, 3))),
            ]
        )
        return (
            F.when(compose.isNull(), _none())
            .when(F.size(parts) >= 4, four)
            .when(F.size(parts) > 1, same(compose))
            .otherwise(same(_with_reform(compose, "; ", F.get(reforms, 0))))
        )

    def same(text: Column) -> Column:
        return once(text, lambda t: _entries([(f"passe_{form}", t) for form in COMPOUND_FORMS]))

    return once(_parts(compose), of_parts)


def active_past(lines: Column) -> Column:
    """Active or pronominal past: simple forms in the first line, compound forms in the second."""
    first, second = F.get(lines, 0), F.get(lines, 1)
    text = squeeze(second["main"])
    reform_text = F.array_join(F.transform(second["rectifs"], strip), " ")
    known = F.struct(
        first["rectifs"].alias("rectifs"),
        _parts(squeeze(first["main"])).alias("forms"),
        F.nullif(text, F.lit("")).alias("compose"),
        F.when(F.size(second["rectifs"]) > 0, F.array(reform_text)).alias("reforms"),
    )

    def entries(known: Column) -> Column:
        rectifs, forms, compose = known["rectifs"], known["forms"], known["compose"]
        simple = _entries(
            [
                ("passe_sm", _with_reform(F.get(forms, 0), "; ", _reform(rectifs, 0))),
                ("passe_sf", F.get(forms, 1)),
                ("passe_pm", _with_reform(F.get(forms, 2), "; ", _reform(rectifs, 1))),
                ("passe_pf", F.get(forms, 3)),
            ]
        )
        invariable = once(F.element_at(_words(compose), -1), lambda word: _entries([(f"passe_{form}", word) for form in PARTICIPLE_FORMS]))
        plain = (
            F.when(F.size(forms) >= 4, simple)
            .when(compose.isNotNull() & ~compose.contains(","), invariable)
            .otherwise(_none())
        )
        return F.concat(plain, _compound(compose, known["reforms"]))

    return once(known, entries)


def passive_past(lines: Column) -> Column:
    """Passive past: compound forms only, and only if there are four."""
    first = F.get(lines, 0)
    known = F.struct(first["rectifs"].alias("rectifs"), squeeze(first["main"]).alias("text"))

    def compound(known: Column) -> Column:
        compose = F.when(F.size(_parts(known["text"])) >= 4, known["text"])
        fixed = F.struct(compose.alias("compose"), F.transform(known["rectifs"], strip).alias("reforms"))
        return once(fixed, lambda x: _compound(x["compose"], x["reforms"]))

    return once(known, compound)
