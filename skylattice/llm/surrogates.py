"""Surrogates for personal data and secrets, in DataFrame functions only.

Entities are found by one pattern: e-mail addresses, secrets in assignments, access keys, phone,
card, account and social-security numbers, IP addresses, and names behind a form of address. Each
entity gets a surrogate drawn by a keyed digest of its type and canonical form, so the same entity has
the same surrogate in every document (coreference), however it is written. Surrogates keep type and
format: digits stay digits, letters keep script and case, separators stay, a card number stays valid or
invalid, a telephone number its leading zeros, a private address private (IPv6 addresses are written out in eight
groups), a given name keeps the gender of its form of address.

A name that a document shows behind a form of address is replaced wherever else it stands in that document, unless
the text also uses the word in lower case. A given name has one gender in a document: that of its forms of
address, neutral if they differ or tell none. Names are composed of syllables and endings by script and gender,
some 10^7 given and 10^8 family names, so few draw again.

Collision check: over all distinct entities, two that draw the same surrogate, or one that draws
another's real value, draw again (all but the smallest), until all surrogates differ. Only
entities that drew again are looked up by the rewriting, which otherwise is a projection.

Defined results: a null text stays null with no entities, an empty one stays empty; texts without
entities come back unchanged; rows that repeat are rewritten alike; an empty table gives no rows.
Input columns named as an output column are replaced; others stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.llm.common import small, stage

# Forms of address, given names and family names to draw from.
MASCULINE = ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Signor", "г-н", "господин", "κύριος"]
FEMININE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Signora", "г-жа", "госпожа", "κυρία"]
NEUTRAL = ["Dr", "Prof", "Doctor", "Professor", "доктор"]

#: Surrogate names are syllables, a consonant and a vowel each, and an ending that tells gender.
SYLLABLES = {
    script: [c + v for c in consonants for v in vowels]
    for script, consonants, vowels in [
        ("latin", "bdfghjklmnprstvz", "aeiou"),
        ("cyrillic", "бвгдзклмнпрстфхш", "аеиоу"),
        ("greek", "βγδζθκλμνπρστφχψ", "αεηιω"),
    ]
}
GIVEN = {
    ("latin", "m"): "bert dor fried las nand rik sten ton".split(),
    ("latin", "f"): "bella dina leen lia nette rosa sina wina".split(),
    ("latin", "n"): "by dy ley mi ne ry sey vy".split(),
    ("cyrillic", "m"): "дан лай мир рей сей тон фим хар".split(),
    ("cyrillic", "f"): "вия дина лия мила ния рина сия тина".split(),
    ("cyrillic", "n"): "ша ся ня ля".split(),
    ("greek", "m"): "νης δης λος μος ρος στος τας κος".split(),
    ("greek", "f"): "δα κη λια μη να ρια σια τη".split(),
    ("greek", "n"): "δι κι λι ρι".split(),
}
FAMILY = {
    "latin": "berg der ford ler man ner sen ski son ton well wick".split(),
    "cyrillic": "бов вин дов ков лев нин ров шин".split(),
    "greek": "δης κης λος νος ρας τος".split(),
}
#: Syllables of a given and of a family name.
GIVEN_SYLLABLES, FAMILY_SYLLABLES = 3, 4

#: What stands before a secret: a keyword, which may be a part of a word, a sign, and opening quotes.
SECRET = (
    r"(?!(?i:secrets?|tokens?):\x20\p{L}{1,7}\x20\p{Ll})"  # prose: a colon and short words
    r"(?i:passwords?|passwd|pwd|tokens?|secrets?|api[_\-\x20]?keys?)"
    r"(?:(?i:keys?|values?|hash|phrase|id|\d+)(?![\p{L}\p{N}])|[_\-.][\p{L}\p{N}_\-.]*|(?<=\p{Ll})\p{Lu}[\p{L}\p{N}_\-.]*)?"
    r"(?:\\?[\"'])?[\x20\x09]*+(?::=|=>|={1,3}|:)[\x20\x09]*+(?:\\?[\"'])?"
)
#: A quoted secret ends at its closing quote in the paragraph, another one at a blank.
_QUOTED = r"(?:[^{q}\\\n]++|\\[\s\S]|\n(?!\s*\n))++(?={q})"
VALUE = (
    r"(?:(?<=\\[\"'])[^\"'\\\n]++(?=\\[\"'])"
    + "|(?<=\")" + _QUOTED.format(q='"') + "|(?<=')" + _QUOTED.format(q="'")
    + r"|(?![\"'])(?:\S*[\p{L}\p{N}]|\S+))"
)
_TITLES = [form for word in MASCULINE + FEMININE + NEUTRAL for form in (word, word.upper())]
TITLE = "(?:" + "|".join(sorted(_TITLES, key=len, reverse=True)) + r")\.?\x20"
#: Signs before an e-mail address that are not a part of it.
SIGNS = r"^[._%+\-]*"
#: A word of a name, without the ending of a possessive.
WORD = r"(?=\p{Lu}(?:\p{L}|['’\-]\p{L}{2}))\p{Lu}\p{L}*+(?:['’\-]\p{L}{2,}+)*+"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
GROUP = r"[0-9A-Fa-f]{1,4}"
#: Telephone numbers without a plus sign or brackets: American ones, others behind a zero.
NATIONAL = (
    r"(?:1[\x20.\-])?\d{3}[\x20.\-]\d{3}[\x20.\-]\d{4}|00\d{1,3}(?:[\x20.\-]\d{2,8}){2,4}"
    r"|0\d{1,4}[\x20/\-]\d{6,8}|0\d{1,4}[\x20/\-]\d{3,4}[\x20\-]\d{3,5}|0\d{1,4}[\x20/\-]\d{3,4}(?:[\x20\-]\d{2}){2}|0\d(?:[\x20.\-]\d{2}){4}"
)
NOT_IN_WORD, NOT_IN_NUMBER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
PATTERNS = {
    "email": r"(?:\G|(?<![\p{L}\p{N}._%+\-]))[._%+\-]*+[\p{L}\p{N}][\p{L}\p{N}._%+\-]*+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    "secret": SECRET + VALUE,
    "key": NOT_IN_WORD + r"AKIA[A-Z0-9]{16}" + NOT_IN_NUMBER,
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[\x20.\-]?)?\(\d{2,4}\)[\x20.\-]?\d{3,4}[\x20.\-]?\d{4}(?!\d)"
    r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[\x20.\-]?\d{2,4}){2,4}(?!\d)"
    rf"|(?<![\p{{L}}\p{{N}}.\-])(?:{NATIONAL})(?![\d\-])",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    "card": NOT_IN_WORD + r"(?:\d{4}[\x20\-]\d{4}[\x20\-]\d{4}[\x20\-]\d{1,7}|\d{4}[\x20\-]\d{6}[\x20\-]\d{4,5}|\d{13,19})" + NOT_IN_NUMBER,
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?<!(?i:version|release)\x20)(?:{OCTET}\.){{3}}{OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[A-Fa-f:]*\d)(?:{GROUP}(?::{GROUP}){{7}}|(?:{GROUP}:{GROUP}|[0-9A-Fa-f]{{3,4}})(?::{GROUP}){{0,5}}::(?:{GROUP}(?::{GROUP}){{0,5}})?)"
    r"(?![\p{L}\p{N}:])",
    "account": NOT_IN_WORD + r"[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?" + NOT_IN_NUMBER,
    "name": NOT_IN_WORD + TITLE + WORD + rf"(?:\x20{WORD}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every entity holds a digit or an at sign, is a key or a secret, or follows a form of address. Few
#: texts have any of these, and this is found in one quick pass.
_FIRST = "".join(sorted({form[0] for form in _TITLES}))
TRIGGER = rf"[0-9@]|(?=[A{_FIRST}])(?:AKIA|{TITLE}\p{{Lu}})|(?=[pPtTsSaA]){SECRET}"
#: Draws after which names and secrets are lengthened and private addresses may become public ones.
DRAWS = 4
#: What secrets without letters and digits are drawn from.
SYMBOLS = "!#$%&*+-/=?@^_~"
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}


def _bound(x: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def people(text: Column) -> Column:
    """The distinct words of names behind a form of address, with what the document tells of them.

    ``bare`` words are replaced without a form of address, too.
    """

    def words(m: Column) -> Column:
        title = F.regexp_extract(m, "^" + TITLE, 0)
        return _bound(
            F.struct(F.split(F.regexp_replace(m, "^" + TITLE, ""), " ").alias("words"), _gender(title).alias("gender")),
            lambda x: F.transform(
                x["words"],
                lambda w, i: F.struct(
                    F.lower(w).alias("word"),
                    ((i == 0) & (F.size(x["words"]) > 1)).alias("given"),
                    x["gender"].alias("gender"),
                    F.when((x["gender"] == "f") & w.rlike(r"\p{IsCyrillic}.*[аА]$"), "а").otherwise("").alias("ending"),
                    w.alias("written"),
                ),
            ),
        )

    none = F.array().cast("array<struct<word:string,given:boolean,gender:string,ending:string,written:string,bare:boolean>>")
    titled = F.regexp_extract_all(text, F.lit(PATTERNS["name"]), F.lit(0))
    common = F.regexp_extract_all(text, F.lit(NOT_IN_WORD + r"\p{Ll}[\p{L}'’\-]*"), F.lit(0))
    fields = ("word", "given", "gender", "ending", "written")
    found = _bound(
        F.array_distinct(F.flatten(F.transform(titled, words))),
        lambda known: _bound(
            F.array_except(F.transform(known, lambda x: x["word"]), common),
            lambda rare: F.transform(
                known, lambda x: F.struct(*[x[f].alias(f) for f in fields], F.array_contains(rare, x["word"]).alias("bare"))
            ),
        ),
    )
    return F.when(text.rlike(NOT_IN_WORD + TITLE + r"\p{Lu}"), found).otherwise(none)


def _with_bare(known: Column) -> Column:
    """The pattern of all entities of a document that knows some names."""

    def forms(x: Column) -> Column:
        w = x["written"]
        return F.array(w, F.upper(w), F.concat(F.substring(w, 1, 1), F.lower(F.substring(w, F.lit(2), F.length(w)))))

    words = F.array_distinct(F.flatten(F.transform(F.filter(known, lambda x: x["bare"]), forms)))
    word = F.concat(F.lit(r"(?:"), F.array_join(F.reverse(F.array_sort(words)), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    bare = F.concat(F.lit("|" + NOT_IN_WORD + r"(?=\p{Lu})"), word, F.lit(r"(?:\x20(?=\p{Lu})"), word, F.lit("){0,2}"))
    return F.when(F.exists(known, lambda x: x["bare"]), F.concat(F.lit(ANY), bare)).otherwise(F.lit(ANY))


def mentions(text: Column, known: Column) -> Column:
    """All entities of a text as written, from left to right."""
    none = F.array().cast("array<string>")
    plain = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    named = F.regexp_extract_all(text, _with_bare(known), F.lit(0))
    return F.when(text.rlike(TRIGGER), F.when(F.size(known) > 0, named).otherwise(plain)).otherwise(none)


def between(text: Column, known: Column) -> Column:
    """What stands before, between and behind the mentions of a text."""
    return F.when(F.size(known) > 0, F.split(text, _with_bare(known), -1)).otherwise(F.split(text, ANY, -1))


def kind(m: Column) -> Column:
    """The type of a mention."""
    tests = [
        ("secret", m.rlike("^" + SECRET)),
        ("email", F.contains(m, F.lit("@"))),
        ("key", m.rlike("^AKIA[A-Z0-9]{16}$")),
        ("name", m.rlike("^" + TITLE)),
        ("ip6", m.rlike("^[0-9A-Fa-f]{1,4}:")),
        ("account", m.rlike(r"^[A-Z]{2}\d{2}")),
        ("ip", m.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$")),
        ("ssn", m.rlike(r"^\d{3}-\d{2}-\d{4}$")),
        ("phone", m.rlike(rf"^(?:\+|\(|(?:{NATIONAL})$)")),
        ("name", ~m.rlike(r"\p{N}")),
    ]
    return reduce(lambda rest, t: F.when(t[1], t[0]).otherwise(rest), reversed(tests), F.lit("card"))


def script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(title: Column) -> Column:
    bare = F.upper(F.rtrim(F.regexp_replace(title, r"\.", "")))
    masculine, feminine = ([word.upper() for word in words] for words in (MASCULINE, FEMININE))
    return F.when(bare.isin(masculine), "m").when(bare.isin(feminine), "f").otherwise("n")


def _part(before: Column, what: Column, canon: Column, written: Column, ending: Column | None = None) -> Column:
    ending = F.lit("") if ending is None else ending
    named = (("before", before), ("kind", what), ("canon", canon), ("written", written), ("ending", ending))
    return F.struct(*[c.alias(n) for n, c in named])


def _name_part(mention: Column, known: Column):
    """A word of a name: given name (of a gender) if it is the first of several, else family name.

    Without a form of address, a word is what the names of the document tell.
    """

    def part(word: Column, i: Column) -> Column:
        def told(hits: Column) -> Column:
            first = (i == 0) & (F.size(mention["words"]) > 1)
            as_given, as_family = F.exists(hits, lambda x: x["given"]), F.exists(hits, lambda x: ~x["given"])
            given = F.when(mention["title"] != "", first).otherwise(as_given & (first | ~as_family))
            m = F.exists(hits, lambda x: x["given"] & (x["gender"] == "m")) | (mention["gender"] == "m")
            f = F.exists(hits, lambda x: x["given"] & (x["gender"] == "f")) | (mention["gender"] == "f")
            gender = F.when(m & ~f, "m").when(f & ~m, "f").otherwise("n")
            # The feminine form of a Cyrillic family name belongs to the masculine one.
            own = (mention["gender"] == "f") & word.rlike(r"\p{IsCyrillic}.*[аА]$")
            ending = F.when(~given & (own | F.exists(hits, lambda x: ~x["given"] & (x["ending"] != ""))), "а").otherwise("")
            canon = F.lower(F.when(ending == "", word).otherwise(F.regexp_replace(word, "[аА]$", "")))
            kinds = F.when(given, F.concat(F.lit("given "), script(word), F.lit(" "), gender))
            kinds = kinds.otherwise(F.concat(F.lit("family "), script(word)))
            return _part(F.when(i == 0, mention["title"]).otherwise(" "), kinds, canon, word, ending)

        return _bound(F.filter(known, lambda x: x["word"] == F.lower(word)), told)

    return part


def _whole_address(m: Column) -> Column:
    """The eight groups of four digits of an IPv6 address."""
    left, right = (F.filter(F.split(F.coalesce(F.get(F.split(m, "::"), F.lit(i)), F.lit("")), ":"), lambda g: g != "") for i in (0, 1))
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), ":")


def _parts(x: Column, known: Column) -> Column:
    """The entities of a typed mention, each with what stands before it."""
    value = x["value"]
    bare = F.upper(F.regexp_replace(x["m"], r"[^\p{L}\p{N}]", ""))
    canon = (
        F.when(x["kind"] == "email", F.lower(F.regexp_replace(x["m"], SIGNS, "")))
        .when((x["kind"] == "secret") & value.rlike("^[0-9A-Fa-f]+$"), F.lower(value))
        .when(x["kind"] == "secret", value)
        .when(x["kind"].isin("key", "ip"), x["m"])
        .when(x["kind"] == "ip6", _whole_address(F.lower(x["m"])))
        .otherwise(bare)
    )
    secret = x["kind"] == "secret"
    email = x["kind"] == "email"
    before = F.when(secret, F.regexp_extract(x["m"], "^" + SECRET, 0)).when(email, F.regexp_extract(x["m"], SIGNS, 0)).otherwise("")
    written = F.when(secret, value).when(email, F.regexp_replace(x["m"], SIGNS, "")).otherwise(x["m"])
    one = F.array(_part(before, x["kind"], canon, written))
    return F.when(x["kind"] == "name", F.transform(x["words"], _name_part(x, known))).otherwise(one)


def parsed(found: Column, known: Column) -> Column:
    """For each mention its entities: what stands before, type, canonical form, and as written.

    ``known`` are the :func:`people` of the document.
    """
    typed = F.transform(
        found,
        lambda m: F.struct(
            m.alias("m"),
            kind(m).alias("kind"),
            F.regexp_extract(m, "^" + TITLE, 0).alias("title"),
            F.regexp_replace(m, "^" + SECRET, "").alias("value"),
            F.split(F.regexp_replace(m, "^" + TITLE, ""), " ").alias("words"),
        ),
    )
    names = ("m", "kind", "title", "value", "words")
    typed = F.transform(
        typed, lambda x: F.struct(*[x[n].alias(n) for n in names], _gender(x["title"]).alias("gender"))
    )
    return _bound(known, lambda p: F.transform(typed, lambda x: _parts(x, p)))


def _number(key: str, what: Column, canon: Column, tries: Column, i: Column) -> Column:
    """A number drawn by the keyed digest."""
    seed = F.concat_ws("|", F.lit(key), what, tries.cast("string"), i.cast("string"), canon, F.lit(key))
    return F.conv(F.substring(F.sha2(seed, 256), 1, 12), 16, 10).cast("long")


def _letter(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), (F.pmod(n, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))


def _drawn_character(x: Column, hexadecimal: Column) -> Column:
    """A character like ``x.c`` by the number ``x.n``; ``x.stays`` and ``x.leads`` say how."""
    c, n = x["c"], x["n"]
    lower = (
        F.when(hexadecimal, _letter("abcdef", n))
        .when(c.rlike(r"\p{IsCyrillic}"), _letter(ALPHABETS["cyrillic"], n))
        .when(c.rlike(r"\p{IsGreek}"), _letter(ALPHABETS["greek"], n))
        .otherwise(_letter(ALPHABETS["latin"], n))
    )
    digit = F.when(x["leads"] & (c != "0"), F.pmod(n, F.lit(9)) + 1).otherwise(F.pmod(n, F.lit(10)))
    return (
        F.when(x["stays"], c)
        .when(c.rlike(r"\p{N}"), digit.cast("string"))
        .when(c.rlike(r"\p{Lu}"), F.upper(lower))
        .when(c.rlike(r"\p{L}"), lower)
        .otherwise(c)
    )


def _luhn(digits: Column) -> Column:
    """Sum of a card number's digits, every second from the right doubled."""
    n = F.length(digits)
    each = F.transform(F.split(digits, ""), lambda c, i: F.when(F.pmod(n - i, F.lit(2)) == 0, c.cast("int") * 2).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d))


def _drawn_card(canon: Column, drawn: Column, n: Column) -> Column:
    """The drawn digits with a last one that is right if it was right, else wrong."""
    body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    right = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    valid = F.pmod(_luhn(canon), F.lit(10)) == 0
    last = F.when(valid, right).otherwise(F.pmod(right + 1 + F.pmod(n, F.lit(9)), F.lit(10)))
    return F.concat(body, last.cast("int").cast("string"))


def _drawn_address(canon: Column, draw, tries: Column) -> Column:
    private = canon.rlike(r"^(?:10|127)\.") & (tries < DRAWS * 2)
    pair = canon.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2\d|3[01])|169\.254)\.") & (tries < DRAWS * 2)
    octets = F.transform(
        F.split(canon, r"\."),
        lambda o, i: F.when(private & (i < 1) | pair & (i < 2), o).otherwise((F.pmod(draw(i), F.lit(223)) + 1).cast("string")),
    )
    return F.array_join(octets, ".")


def _drawn_name(what: Column, draw, tries: Column) -> Column:
    """Syllables and an ending, all taken from one number; later draws are longer."""

    def by_script(choices: dict[str, Column]) -> Column:
        return F.when(what.contains("cyrillic"), choices["cyrillic"]).when(what.contains("greek"), choices["greek"]).otherwise(choices["latin"])

    def literal(names: list[str]) -> Column:
        return F.array(*[F.lit(x) for x in names])

    count = F.when(what.startswith("given"), GIVEN_SYLLABLES).otherwise(FAMILY_SYLLABLES)
    count = (count + F.greatest(tries - DRAWS + 1, F.lit(0))).cast("int")
    endings = by_script({s: literal(names) for s, names in FAMILY.items()})
    for (s, g), names in GIVEN.items():
        endings = F.when(what == f"given {s} {g}", literal(names)).otherwise(endings)
    syllables = by_script({s: literal(names) for s, names in SYLLABLES.items()})

    def syllable(i: Column) -> Column:
        # Four syllables of a number, then the next number.
        part = F.floor(draw(F.floor(i / 4)) / F.pow(F.lit(len(SYLLABLES["latin"])), F.pmod(i, F.lit(4)))).cast("long")
        return F.get(syllables, F.pmod(part, F.size(syllables).cast("long")).cast("int"))

    body = F.array_join(F.transform(F.sequence(F.lit(0), count - 1), syllable), "")
    ending = F.get(endings, F.pmod(draw(F.lit(-1)), F.size(endings).cast("long")).cast("int"))
    return F.concat(body, ending)


def drawn(key: str, what: Column, canon: Column, tries: Column) -> Column:
    """The surrogate, in canonical form, that an entity gets at a draw."""

    def draw(i: Column) -> Column:
        return _number(key, what, canon, tries, i)

    hexadecimal = (what == "secret") & canon.rlike("^[0-9a-f]+$") | (what == "ip6")
    # Parts that say nothing of a person stay: key prefix, country of an account, top-level domain,
    # kind of a private address.
    # A telephone number keeps the zeros before it and the one of the American form.
    trunk = F.length(F.regexp_extract(canon, r"^(?:0+|1(?=\d{10}$))", 0))
    head = F.when(what == "key", 4).when(what == "phone", trunk).when(what == "account", 2).when((what == "ip6") & canon.rlike("^f[cde]"), 4).otherwise(0)
    tail = F.when(what == "email", F.length(F.regexp_extract(canon, r"(?:\.example)?\.\p{L}+$", 0))).otherwise(0)
    numbers, n = what.isin("phone", "card", "ssn"), F.length(canon)
    each = F.transform(
        F.split(canon, ""),
        lambda c, i: F.struct(
            c.alias("c"),
            draw(i).alias("n"),
            ((i < head) | (i >= n - tail)).alias("stays"),
            (numbers & (i == F.when(what == "phone", trunk).otherwise(0))).alias("leads"),
        ),
    )
    plain = F.array_join(F.transform(each, lambda x: _drawn_character(x, hexadecimal)), "")
    symbolic = (what == "secret") & ~canon.rlike(r"[\p{L}\p{N}]")
    symbols = F.array_join(F.transform(each, lambda x: _letter(SYMBOLS, x["n"])), "")
    # Short secrets may be more than there are others of their length.
    more = F.transform(F.sequence(F.lit(-2), -1 - F.greatest(tries - DRAWS + 2, F.lit(1)), F.lit(-1)), lambda i: _letter("abcdef", draw(i)))
    secret = F.when(symbolic, symbols).otherwise(plain)
    secret = F.when(tries < DRAWS, secret).otherwise(F.concat(secret, F.array_join(more, "")))
    return (
        F.when(what == "ip", _drawn_address(canon, draw, tries))
        .when(what.startswith("given") | what.startswith("family"), _drawn_name(what, draw, tries))
        .when(what == "card", _drawn_card(canon, plain, draw(F.lit(-1))))
        .when(what == "secret", secret)
        .otherwise(plain)
    )


def collisions(found: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, tries)`` of the distinct entities ``found`` that must not keep their first draw."""
    real = found.select("kind", F.col("canon").alias("drawn"))
    left = found.withColumn("tries", F.lit(0))
    settled = None
    while True:
        left = left.withColumn("drawn", drawn(key, F.col("kind"), F.col("canon"), F.col("tries")))
        left = stage(left, "draws")
        taken = real if settled is None else real.union(settled.select("kind", "drawn"))
        free = left.join(taken.distinct(), ["kind", "drawn"], "left_anti")
        won = free.groupBy("kind", "drawn").agg(F.min("canon").alias("canon"), F.min("tries").alias("tries"))
        won = stage(won.select("kind", "canon", "tries", "drawn"), "settled")
        settled = won if settled is None else settled.union(won)
        left = left.join(won.select("kind", "canon"), ["kind", "canon"], "left_anti")
        left = stage(left.select("kind", "canon", (F.col("tries") + 1).alias("tries")), "again")
        if left.isEmpty():
            return stage(settled.where("tries > 0").select("kind", "canon", "tries"), "redrawn")


def _laid_out(m: Column, stream: Column) -> Column:
    """A mention with its letters and digits taken from a stream, one after the other."""
    start = F.struct(F.lit("").alias("out"), stream.alias("rest"))
    done = F.aggregate(
        F.split(m, ""),
        start,
        lambda s, c: F.when(
            c.rlike(r"[\p{L}\p{N}]"),
            F.struct(
                F.concat(s["out"], F.substring(s["rest"], 1, 1)).alias("out"),
                F.substring(s["rest"], F.lit(2), F.length(s["rest"])).alias("rest"),
            ),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["rest"].alias("rest"))),
    )
    return done["out"]


def _cased(written: Column, new: Column) -> Column:
    """``new`` with the case of each character of ``written``."""
    pairs = F.zip_with(F.split(written, ""), F.split(new, ""), lambda a, b: F.when(a.rlike(r"\p{Lu}"), F.upper(b)).otherwise(b))
    return F.array_join(pairs, "")


def replaced(key: str, found: Column, known: Column, again: Column) -> Column:
    """The surrogates of mentions, in their format; ``again`` maps entities to their draw."""

    def renewed(p: Column) -> Column:
        tries = F.coalesce(F.try_element_at(again, F.concat(p["kind"], F.lit(":"), p["canon"])), F.lit(0))
        names = ("before", "kind", "canon", "written", "ending")
        return F.struct(*[p[n].alias(n) for n in names], tries.alias("tries"))

    def drawn_part(p: Column) -> Column:
        new = drawn(key, p["kind"], p["canon"], p["tries"])
        return F.struct(*[p[n].alias(n) for n in ("before", "kind", "written", "ending")], new.alias("new"))

    def laid(p: Column) -> Column:
        name, new, written = p["kind"].rlike("^(?:given|family) "), p["new"], p["written"]
        word = F.concat(new, p["ending"])
        title = F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word)))
        shouted = (written == F.upper(written)) & (F.length(written) > 1)
        return F.concat(
            p["before"],
            F.when(name & shouted, F.upper(word))
            .when(name, title)
            .when(p["kind"].isin("secret", "email"), _cased(written, new))
            .when(p["kind"].isin("key", "ip", "ip6"), new)
            .otherwise(_laid_out(written, new)),
        )

    steps = F.transform(parsed(found, known), lambda parts: F.transform(parts, renewed))
    steps = F.transform(steps, lambda parts: F.transform(parts, drawn_part))
    return F.transform(steps, lambda parts: F.array_join(F.transform(parts, laid), ""))


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit(3), text).alias("__t2")]


def anonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``, the number of mentions replaced."""
    keep = [c for c in docs.columns if c != "n_entities"]
    found = docs.select("text").where(F.col("text").rlike(TRIGGER)).withColumn("__people", people(F.col("text")))
    parts = parsed(mentions(F.col("text"), F.col("__people")), F.col("__people"))
    pairs = found.select(*_text_key(F.col("text")), F.explode(F.flatten(parts)).alias("e"))
    pairs = stage(pairs.select("__t1", "__t2", "e.kind", "e.canon").distinct(), "entities")
    again = collisions(pairs.select("kind", "canon").distinct(), key)
    # Texts that hold an entity that drew again, with its draw.
    marks = pairs.join(small(again), ["kind", "canon"]).groupBy("__t1", "__t2")
    entry = F.struct(F.concat("kind", F.lit(":"), "canon"), "tries")
    marks = stage(marks.agg(F.map_from_entries(F.collect_list(entry)).alias("__again")), "marks")
    rows = docs.select(*[c for c in keep], *_text_key(F.col("text")))
    rows = rows.join(small(marks, 100_000), ["__t1", "__t2"], "left")
    rows = rows.withColumn("__people", people(F.col("text")))
    rows = rows.withColumn("__found", mentions(F.col("text"), F.col("__people")))
    others = between(F.col("text"), F.col("__people"))
    new = F.zip_with(
        replaced(key, F.col("__found"), F.col("__people"), F.col("__again")),
        F.slice(others, F.lit(2), F.size("__found")),
        lambda surrogate, rest: F.concat(surrogate, rest),
    )
    text = F.when(F.size("__found") > 0, F.concat(F.get(others, F.lit(0)), F.array_join(new, ""))).otherwise(F.col("text"))
    rows = rows.withColumn("__new", text)
    columns = [F.col("__new").alias("text") if c == "text" else F.col(c) for c in keep]
    return rows.select(*columns, F.size("__found").cast("long").alias("n_entities"))
