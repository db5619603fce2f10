"""Surrogates for personal data, with DataFrame functions only.

A detected entity is replaced by another of its kind that a key decides.  Its letters and digits, in
order and without regard to case and separators, go through a keyed Feistel network over each
character's own alphabet: digits stay digits, vowels vowels, Greek Greek, and everything between
them, the case and the length stay as they were.  The network is a bijection, so one entity has one
surrogate in the whole corpus (also where it is written with other separators), and two entities
never share one; ``collisions`` checks that on data.  Nothing is collected, joined or shuffled.

Card numbers keep whether their check digit is right, addresses of hosts stay in range, the country
code of a phone number and the last part of a mail domain stay, a name keeps its title and the last
letter of each word, which carries the gender.

Names are found behind titles and permuted word by word, so a word of a name has one surrogate in all
its names; every other place where a text writes such a word is replaced too, titled or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 4
_ALPHABETS = (
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ",
)
# kinds in the order in which they are tried; each pattern is whole in itself
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)*(?<=\.\p{L}{2,24})",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+1[ .-]?)?\(?\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
             r"|(?<![\w+.-])(?:\+1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
             r"|(?<![\w+])\+(?!1[ .(-])\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,5}){2,4}(?!\w)",
    "card": r"(?<![\w.-])(?:\d{4}[ -]){3}\d{1,7}(?![\w-])|(?<![\w.-])\d{13,19}(?![\w-])",
    "iban": r"(?<!\w)\p{Lu}{2}\d{2} ?[\p{Lu}\d]{4}(?: ?\d{4}){2,6}(?: ?\d{1,3})?(?!\w)",
    "name": r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame|Κύριος|Κυρία|Господин|Госпожа)\.?"
            r"(?: \p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?){1,3}",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _alphabet(c: Column) -> Column:
    """The alphabet of a lower-case character, null where it is kept as it is."""
    return F.coalesce(*[F.when(F.position(c, F.lit(a)) > 0, F.lit(a)) for a in _ALPHABETS])


def _number(*parts: Column | str) -> Column:
    """A keyed number below 2**32 from the parts."""
    joined = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 8), 16, 10).cast("long")


def _permuted(chars: Column, kind: str, key: str) -> Column:
    """Characters of the alphabets, permuted: half of them is shifted by what the other half says, in turn."""

    def turn(seq: Column, step: int) -> Column:
        half = F.array_join(F.filter(seq, lambda c, i: i % 2 != step % 2), "")
        return _let(half, lambda other: F.transform(seq, lambda c, i: F.when(i % 2 != step % 2, c).otherwise(_let(
            _alphabet(c),
            lambda a: F.substring(a, F.pmod(F.position(c, a) - 1 + _number(key, kind, str(step), i, F.size(seq), other), F.length(a)).cast("int") + 1, F.lit(1))))))

    out = chars
    for step in range(ROUNDS):
        out = _turned(out, step, turn)
    return out


def _turned(chars: Column, step: int, turn) -> Column:
    return _let(chars, lambda seq: turn(seq, step))


def _replaced(text: Column, kind: str, key: str, held) -> Column:
    """``text`` with its characters of the alphabets permuted in place; ``held`` names those that stay."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    marked = lambda cs: F.transform(cs, lambda c, i: F.struct(
        c.alias("c"), (_alphabet(F.lower(c)).isNotNull() & ~held(cs, i)).alias("moves")))

    def refill(ms: Column) -> Column:
        own = F.transform(F.filter(ms, lambda m: m["moves"]), lambda m: F.lower(m["c"]))
        return _let(_permuted(own, kind, key), lambda new: F.array_join(F.transform(ms, lambda m, i: F.when(
            ~m["moves"], m["c"]).otherwise(_let(
                F.get(new, F.size(F.filter(F.slice(ms, F.lit(1), i), lambda x: x["moves"]))),
                lambda n: F.when(m["c"] == F.lower(m["c"]), n).otherwise(F.upper(n))))), ""))

    return _let(chars, lambda cs: _let(marked(cs), refill))


def _none_held(chars: Column, i: Column) -> Column:
    return F.lit(False)


def _last_letters(chars: Column, i: Column) -> Column:
    return ~F.coalesce(F.rlike(F.get(chars, i + 1), F.lit(r"\p{L}")), F.lit(False))


def _check_sum(digits: Column) -> Column:
    """The digit that a number's other digits ask for (Luhn)."""
    back = F.reverse(digits)
    weighed = F.transform(back, lambda d, i: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.pmod(F.lit(10) - F.pmod(F.aggregate(weighed, F.lit(0), lambda a, d: a + d), F.lit(10)), F.lit(10))


def _digits(text: Column) -> Column:
    only = F.regexp_replace(text, F.lit(r"\D"), F.lit(""))
    return F.transform(F.filter(F.split(only, ""), lambda c: c != ""), lambda c: c.cast("int"))


def _card(text: Column, key: str) -> Column:
    last = F.substring(text, F.length(text), F.lit(1)).cast("int")
    head = F.substring(text, F.lit(1), F.length(text) - 1)
    return _let(_replaced(head, "card", key, _none_held), lambda new: F.concat(
        new, F.pmod(last + _check_sum(_digits(new)) - _check_sum(_digits(head)), F.lit(10)).cast("string")))


def _host(text: Column, key: str) -> Column:
    parts = F.transform(F.split(text, r"\."), lambda p: p.cast("int"))
    for step in range(ROUNDS):
        parts = _turned(parts, step, lambda seq, s: _host_turn(seq, s, key))
    return F.array_join(F.transform(parts, lambda p: p.cast("string")), ".")


def _host_turn(seq: Column, step: int, key: str) -> Column:
    other = F.array_join(F.transform(F.filter(seq, lambda p, i: i % 2 != step % 2), lambda p: p.cast("string")), ".")
    return _let(other, lambda o: F.transform(seq, lambda p, i: F.when(i % 2 != step % 2, p).otherwise(
        F.pmod(p + _number(key, "ip", str(step), i, o), F.lit(256)).cast("int"))))


def _after(text: Column, kept: str, rest) -> Column:
    """The beginning that matches ``kept`` as it is, then ``rest`` of what follows."""
    head = F.regexp_extract(text, kept, 0)
    return _let(head, lambda h: F.concat(h, rest(F.substring(text, F.length(h) + 1, F.length(text)))))


def _kind(entity: Column) -> Column:
    return F.coalesce(*[F.when(F.rlike(entity, F.lit(f"^(?:{p})$")), F.lit(kind)) for kind, p in PATTERNS.items()])


def surrogate(entity: Column, kind: Column, key: str) -> Column:
    """What an entity of a kind is replaced by."""
    tail = F.regexp_extract(entity, r"\.[^.]+$", 0)
    head = F.substring(entity, F.lit(1), F.length(entity) - F.length(tail))
    of_kind = {
        "email": F.concat(_replaced(head, "email", key, _none_held), tail),
        "ip": _host(entity, key),
        "ssn": _replaced(entity, "ssn", key, _none_held),
        "phone": _after(entity, r"^(?:\+1[ .-]?|\+\d{1,3}(?=[ .(-]))?", lambda x: _replaced(x, "phone", key, _none_held)),
        "card": _card(entity, key),
        "iban": _after(entity, r"^..", lambda x: _replaced(x, "iban", key, _none_held)),
        "name": _after(entity, r"^\p{L}+\.? ", lambda x: F.array_join(F.transform(_words(x), lambda w: _name_word(w, key)), "")),
    }
    return F.coalesce(*[F.when(kind == k, of) for k, of in of_kind.items()])


def _words(text: Column) -> Column:
    """A text cut into its runs of letters and what stands between them; put together they are the text."""
    return F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))


def _name_word(word: Column, key: str) -> Column:
    return F.when(F.rlike(word, F.lit(r"^\p{L}")), _replaced(word, "name", key, _last_letters)).otherwise(word)


def _name_words(found: Column, key: str) -> Column:
    """(word, surrogate) of the words of all names found, without the titles."""
    names = F.transform(F.filter(found, lambda f: f["kind"] == "name"), lambda f: F.regexp_replace(f["entity"], F.lit(r"^\p{L}+\.? "), F.lit("")))
    words = F.filter(F.array_distinct(F.flatten(F.transform(names, _words))), lambda w: F.rlike(w, F.lit(r"^\p{L}")))
    return F.transform(words, lambda w: F.struct(w.alias("word"), _name_word(w, key).alias("surrogate")))


def _again(text: Column, names: Column) -> Column:
    """``text`` with each word that is one of ``names`` replaced, in one pass, so no surrogate is replaced again."""
    new = lambda w: F.get(F.filter(names, lambda n: n["word"] == w), F.lit(0))["surrogate"]
    return F.when(F.size(names) > 0, F.array_join(F.transform(_words(text), lambda w: F.coalesce(new(w), w)), "")).otherwise(text)


def _entities(text: Column, key: str) -> Column:
    """(kind, entity, surrogate) of everything found in a text, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)), lambda e: _let(_kind(e), lambda k: F.struct(
        k.alias("kind"), e.alias("entity"), surrogate(e, k, key).alias("surrogate"))))


def replace_entities(docs: DataFrame, key: str, text_col: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with every entity of ``text_col`` replaced; with ``counts``, also n_<kind> columns.

    All rows and columns stay, in order; a column of ``docs`` that has the name of a count is replaced
    by it.  The words of a text's names are replaced wherever it writes them, titled or not.  Null stays
    null; a text without an entity stays as it is, byte for byte.  Equal texts get
    equal results.  Whole texts are searched.
    """
    text, found = F.col(text_col), "_found"
    while found in docs.columns:
        found += "_"
    marked = docs.withColumn(found, F.when(F.rlike(text, F.lit("[0-9@]|\\p{Lu}\\p{Ll}+\\.? \\p{Lu}")), _entities(text, key)))
    # what stands between the entities may write a word of a name again
    rebuilt = _let(_name_words(F.col(found), key), lambda names: F.array_join(F.flatten(F.zip_with(
        F.split(text, _ANY, -1), F.col(found), lambda p, f: F.array(_again(p, names), F.coalesce(f["surrogate"], F.lit(""))))), ""))
    has = F.coalesce(F.size(found), F.lit(0)) > 0
    new = F.when(has, rebuilt).otherwise(text).alias(text_col)
    count = lambda kind: F.coalesce(F.size(F.filter(found, lambda f: f["kind"] == kind)), F.lit(0)).cast("long")
    extra = [count(kind).alias(f"n_{kind}") for kind in PATTERNS] if counts else []
    named = {f"n_{kind}" for kind in PATTERNS} if counts else set()
    return marked.select(*[new if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in named], *extra)


def surrogates(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(kind, entity, surrogate) for each distinct entity of the corpus."""
    found = docs.filter(F.col(text_col).isNotNull()).select(F.explode(_entities(F.col(text_col), key)).alias("f"))
    return found.select("f.*").distinct()


def collisions(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Surrogates that stand for entities of different letters and digits; empty if all is well."""
    letters = F.regexp_replace(F.lower("entity"), r"[^\p{L}\p{N}@]", "")
    table = surrogates(docs, key, text_col).select("kind", "surrogate", F.when(F.col("kind") == "ip", F.col("entity")).otherwise(letters).alias("one"))
    return table.groupBy("kind", "surrogate").agg(F.countDistinct("one").alias("entities")).filter("entities > 1")
