"""Personal data replaced by surrogates of the same type, format, script and gender.

Entities are found by patterns: e-mail, IPv4 and IPv6 addresses, phone, card, social security and
account numbers, access tokens, and names after a title.  Words of a name that is found are
replaced wherever else they stand in the same text, too.  Each distinct entity gets one surrogate
in the whole corpus, made from a keyed hash, so the same entity reads the same everywhere and
nobody without the key can go back.  An entity is known by a canonical form (lower case, numbers
without their punctuation), and each occurrence gets the surrogate in its own punctuation and
case.  What is kept: the country of phone and account numbers, the first digit of a card and
whether its check digit is right, the top domain of an address, private networks, titles.  Equal
domains, given names and surnames get equal surrogates, alone or together.  A given name is that of a
woman or a man by the titles that it has in the whole corpus, and gets a neutral form where these say
neither, so a person stays one person after Dr and after Mrs.  Letters are replaced by letters of their script, those
of scripts not listed by Latin ones, never by themselves as a rule.

Collision checks: no two entities of a type share a surrogate, and no surrogate is itself an
entity of the corpus; those that fail try again with another hash.  What is left after that, where
a form is nearly full, is assigned exactly from the unused surrogates of its form.

All work is column expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.operators.skew import join_per_key
from lexspark.session import release, stage

# What entities look like.
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Lord", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος"],
    "f": [
        "Mrs", "Ms", "Miss", "Madam", "Lady", "Dame", "Frau", "Fräulein", "Madame", "Mme", "Mademoiselle", "Mlle",
        "Señora", "Sra", "Señorita", "Srta", "Signora", "Signorina", "Госпожа", "Κυρία",
    ],
    "": ["Dr", "Doctor", "Prof", "Professor", "Docteur", "Доктор", "Профессор"],
}
ALL_TITLES = [title for titles in TITLES.values() for title in titles]
_TITLED = rf"(?:(?:{'|'.join(ALL_TITLES)})\.? )++"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_HEX = r"[0-9A-Fa-f]{1,4}"
_NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}\p{L}*+(?:[-'’](?!s(?!\p{L}))\p{L}++)*+(?!\d)"
_INITIALS = r"(?:\p{Lu}\.-?){1,3}+"
_PARTICLES = r"(?:(?:van|von|vom|zu|zur|ter|ten|de|der|den|del|della|di|da|dos|du|la|le|bin|ibn|al|y) ){0,3}+"
_NATIONAL = (
    r"(?<![\p{L}\d+])(?<!\d[.-])(?:(?:1[-. ])?\d{3}(?<gap>[-. ])\d{3}\k<gap>\d{4}"
    r"|0\d{1,4}[ -]\d{3,4}[ -]\d{3,4}|0\d{2,4}[ /-]\d{5,8}|0\d(?<two>[ .-])\d\d(?:\k<two>\d\d){3})(?!\d|[.-]\d)"
)
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+-]*+@[\p{L}\p{M}\p{N}-]++(?:\.[\p{L}\p{M}\p{N}-]++)*+(?<=\.[\p{L}\p{M}]{2,63})",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ip6": rf"(?<![\p{{L}}\d:.])(?=[A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![\p{{L}}\d:]|\.\d)",
    "phone": rf"(?<![\d+])(?:\+\d{{1,3}}[ .-]?)?\(\d{{2,4}}\) ?\d{{3,4}}[ .-]?\d{{3,4}}(?!\d)|(?<![\d+])\+\d{{1,3}}(?:[ .-]?\d{{2,4}}){{3,4}}(?!\d)|{_NATIONAL}",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\p{L}\d])(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}(?<by>[ -])\d{6}\k<by>\d{4,5}|[2-6]\d{12,14})(?![\p{L}\d])",
    "token": r"(?<![\p{L}\d])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\d])",
    "account": r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "name": rf"(?<![\p{{L}}\d]){_TITLED}(?:{_INITIALS} ?){{0,3}}{_PARTICLES}{_NAME}(?: (?:{_INITIALS} ){{0,3}}{_PARTICLES}{_NAME}){{0,3}}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values()).replace("([ -]?)", "(?<cut>[ -]?)").replace(r"\1", r"\k<cut>")
TRIES_BESIDE_ENTITIES, TRIES = 12, 40

# letters to choose from by script, 128 at most; of scripts with capital letters also the syllables of
# names and the endings of a man's, a woman's and a neutral one
_LETTERS = {
    "Latin": "abcdefghijklmnopqrstuvwxyz",
    "Cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
    "Greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "Devanagari": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
    "Thai": "กขคงจฉชซญดตถทธนบปผพฟภมยรลวศสหอ",
    "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ",
    "Hangul": "".join(map(chr, range(0xAC00, 0xAC00 + 28 * 64, 28))),
    "Han": "".join(map(chr, range(0x5200, 0x5280))),
}
_NAMES = {
    "Latin": ("ba de ka lo mi no pe ra su ta ve zo fi ga hu je", ("n r s l", "a ia na ra", "e i o u")),
    "Cyrillic": ("ба де ка ло ми но пе ра су та ве зо фи га ху же", ("н р с л", "а ия на ра", "е и о ю")),
    "Greek": ("βα δε κα λο μι νο πε ρα σου τα βε ζο φι γα χου ζε", ("ν ρ ς λ", "α ια να ρα", "ε ι ο ω")),
}


def _by_script(c: Column, chosen) -> Column:
    """``chosen(letters)`` with the letters of the character's script, Latin ones where it is not listed."""
    out = chosen(_LETTERS["Latin"])
    for script, letters in reversed(_LETTERS.items()):
        out = F.when(c.rlike(rf"\p{{Is{script}}}"), chosen(letters)).otherwise(out)
    return out


def may_hold(text: Column) -> Column:
    """A quick test that all texts with an entity pass: a digit, an at sign or a title."""
    found = text.rlike("[0-9@]")
    for title in ALL_TITLES:
        found = found | text.contains(title + " ") | text.contains(title + ". ")
    return found


def find(text: Column) -> Column:
    """All occurrences in a text, in order; null for a text without any sign of one."""
    return F.when(may_hold(text), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))


def _type(occurrence: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(occurrence.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def _words(occurrence: Column) -> Column:
    """The words of a name after its titles; initials with a point are words of their own."""
    return F.split(F.regexp_replace(F.regexp_replace(occurrence, f"^{_TITLED}", ""), r"\.(?=\p{Lu}['’\p{Ll}])", ". "), " ")


def parts(occurrence: Column, kind: Column) -> Column:
    """The entities in an occurrence, ``(type, canonical)``: one, or the words of a name."""
    words = _words(occurrence)

    def entity(type_: Column, canonical: Column) -> Column:
        return F.struct(type_.alias("type"), canonical.alias("canonical"))

    plain = F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(occurrence, r"\D", "")).when(
        kind == "account", F.lower(F.replace(occurrence, F.lit(" "), F.lit("")))
    ).otherwise(F.lower(occurrence))
    return (
        F.when(kind != "name", F.array(entity(kind, plain)))
        .otherwise(
            F.transform(
                words,
                lambda word, i: entity(
                    F.when(word.contains("."), "initial")
                    .when(~F.substring(word, 1, 1).rlike(r"\p{Lu}"), "particle")
                    .when(i == F.size(words) - 1, "surname")
                    .otherwise("given"),
                    F.lower(word),
                ),
            )
        )
    )


def gender(occurrence: Column) -> Column:
    """What the titles of a name say: f, m or nothing."""
    titles = F.regexp_extract(occurrence, f"^{_TITLED}", 0)
    said = F.lit("")
    for g in ("m", "f"):
        said = F.when(titles.rlike(rf"(?:^| )(?:{'|'.join(TITLES[g])})\.? "), g).otherwise(said)
    return said


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _number(digest: Column, at: Column) -> Column:
    """A number below 256 from the two hexadecimal digits at a place."""
    return F.conv(F.substring(digest, F.pmod(at, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(choices: str, number: Column) -> Column:
    return F.substring(F.lit(choices), F.pmod(number, F.lit(len(choices))) + 1, F.lit(1))


def _digit_sum(digits: Column) -> Column:
    """The sum that the check digit of a card completes to a multiple of ten."""
    numbers = F.transform(F.reverse(_characters(digits)), lambda c: c.cast("int"))
    weighted = F.transform(
        numbers, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))
    )
    return F.aggregate(weighted, F.lit(0), lambda a, d: a + d)


def surrogate(kind: Column, canonical: Column, key: str, attempt: int, digest: Column | None = None) -> Column:
    """The surrogate of an entity, in canonical form; ``digest`` stands for its keyed hash."""
    digest = digest if digest is not None else F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, F.lit(str(attempt))), 512)
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.substring_index(canonical, "@", -1)), 512)

    def other(c: Column, number: Column) -> Column:
        letter = _by_script(c, lambda letters: _pick(letters, number))
        return F.when(c.rlike(r"\p{N}"), _pick("0123456789", number)).when(c.rlike(r"[\p{L}\p{M}]"), letter).otherwise(c)

    size = F.length(canonical)
    top = size - F.length(F.substring_index(canonical, ".", -1))
    at_sign = F.instr(canonical, "@") - 1

    def mail(c: Column, i: Column) -> Column:
        number = F.when(i > at_sign, _number(domain, i - at_sign)).otherwise(_number(digest, i))
        return F.when(i >= top, c).otherwise(other(c, number))

    def joined(each) -> Column:
        return F.array_join(F.transform(_characters(canonical), each), "")

    def kept(n: int) -> Column:
        return joined(lambda c, i: F.when(i < n, c).otherwise(other(c, _number(digest, i))))

    card = kept(1)
    rest = F.concat(F.substring(card, F.lit(1), size - 1), F.lit("0"))
    card = F.concat(
        F.substring(card, F.lit(1), size - 1), F.pmod(_digit_sum(canonical) - _digit_sum(rest), F.lit(10)).cast("string")
    )
    hexadecimal = lambda c, i: F.when(c.rlike(r"\d"), _pick("0123456789", _number(digest, i))).otherwise(_pick("abcdef", _number(digest, i)))
    local = F.when(canonical.rlike("^(?:fe80|f[cd]..):"), 4).otherwise(1)
    ip6 = joined(lambda c, i: F.when((i < local) & (F.instr(canonical, ":") > local) | (c == ":"), c).otherwise(hexadecimal(c, i)))
    octets = F.split(canonical, r"\.")
    private = F.when(canonical.rlike(r"^(?:10|127)\."), 1).when(
        canonical.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2\d|3[01]))\."), 2
    ).otherwise(0)
    ip = F.array_join(
        F.transform(
            octets,
            lambda o, i: F.when(i < private, o).otherwise(
                F.when(i == 0, F.pmod(_number(digest, i), F.lit(99)) + 11).otherwise(_number(digest, i)).cast("string")
            ),
        ),
        ".",
    )

    def name(script: str) -> Column:
        syllables, endings = _NAMES[script][0].split(), _NAMES[script][1]
        choices = F.array(*map(F.lit, syllables))
        stem = F.concat(*(F.get(choices, F.pmod(_number(digest, F.lit(i)), F.lit(len(syllables)))) for i in range(3 + attempt % 8)))
        man, woman, neutral = (F.get(F.array(*map(F.lit, e.split())), F.pmod(_number(digest, F.lit(40)), F.lit(4))) for e in endings)
        return F.concat(stem, F.when(kind == "given_f", woman).when(kind == "given_n", neutral).otherwise(man))

    return (
        F.when(kind == "email", joined(mail))
        .when(kind == "ip", ip)
        .when(kind == "ip6", ip6)
        .when(kind == "card", card)
        .when(kind == "phone", kept(1))
        .when(kind == "account", kept(2))
        .when(kind == "token", joined(hexadecimal))
        .when(kind.isin("ssn", "initial"), kept(0))
        .when(kind == "particle", canonical)
        .when(canonical.rlike(r"\p{IsCyrillic}"), name("Cyrillic"))
        .when(canonical.rlike(r"\p{IsGreek}"), name("Greek"))
        .otherwise(name("Latin"))
    )


def _rendered(occurrence: Column, kind: Column, found: Column) -> Column:
    """An occurrence with the surrogates of its parts in its own punctuation and case."""
    surrogate_ = found[0]

    def step(state: Column, c: Column) -> Column:
        own = F.substring(surrogate_, state["i"], F.lit(1))
        cased = F.when((F.upper(c) == c) & (F.lower(c) != c), F.upper(own)).otherwise(own)
        letter = c.rlike(r"[\p{L}\p{M}\p{N}]")
        keeps = kind.isin("phone", "card", "ssn", "account") & ~letter
        return F.struct(
            F.when(keeps, state["i"]).otherwise(state["i"] + 1).alias("i"),
            F.concat(state["out"], F.when(letter, cased).otherwise(c)).alias("out"),
        )

    filled = F.aggregate(
        _characters(occurrence), F.struct(F.lit(1).alias("i"), F.lit("").alias("out")), step, lambda s: s["out"]
    )
    titles = F.regexp_extract(occurrence, f"^({_TITLED})", 1)
    words = F.zip_with(
        found,
        _words(occurrence),
        lambda s, word: F.when(word.contains("."), F.upper(s)).when(F.substring(word, 1, 1).rlike(r"\p{Lu}"), F.initcap(s)).otherwise(s),
    )
    name, glued = F.array_join(words, " "), ~F.regexp_replace(occurrence, f"^{_TITLED}", "").contains(". ")
    return (
        F.when(kind == "ip", surrogate_)
        .when(kind == "token", F.when(occurrence.rlike("[A-F]"), F.upper(surrogate_)).otherwise(surrogate_))
        .when(kind == "name", F.concat(titles, F.when(glued, F.replace(name, F.lit(". "), F.lit("."))).otherwise(name)))
        .otherwise(filled)
    )


def _radices(kind: Column, canonical: Column) -> Column:
    """How many values a surrogate may take at each place of the digest."""
    size, at_sign = F.length(canonical), F.instr(canonical, "@") - 1
    local = F.when(canonical.rlike("^(?:fe80|f[cd]..):"), 4).otherwise(1)
    private = F.when(canonical.rlike(r"^(?:10|127)\."), 1).when(
        canonical.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2\d|3[01]))\."), 2
    ).otherwise(0)

    def at(c: Column, i: Column) -> Column:
        letters = _by_script(c, lambda letters: F.lit(len(letters)))
        other = F.when(c.rlike(r"\p{N}"), 10).when(c.rlike(r"[\p{L}\p{M}]"), letters).otherwise(1)
        hexadecimal = F.when(c.rlike(r"\d"), 10).otherwise(6)
        return (
            F.when((kind == "email") & (i >= at_sign), 1)
            .when((kind == "card") & ((i < 1) | (i == size - 1)) | (kind == "phone") & (i < 1) | (kind == "account") & (i < 2), 1)
            .when((kind == "ip6") & ((i < local) & (F.instr(canonical, ":") > local) | (c == ":")), 1)
            .when(kind.isin("ip6", "token"), hexadecimal)
            .otherwise(other)
        )

    syllables = 3 + (TRIES - 1) % 8
    name = F.array(*(F.lit(16 if i < syllables else 4 if i == 40 else 1) for i in range(41)))
    octets = F.transform(F.split(canonical, r"\."), lambda _, i: F.when(i < private, 1).when(i == 0, 99).otherwise(256))
    places = F.slice(F.transform(_characters(canonical), at), 1, 64)
    return F.when(kind == "ip", octets).when(kind.isin("given_f", "given_m", "given_n", "surname"), name).otherwise(places)


def _digest_of(number: Column, radices: Column) -> Column:
    """A digest whose places are the digits of a number in mixed radices."""
    start = F.struct(number.cast("long").alias("n"), F.lit("").alias("out"))

    def step(state: Column, r: Column) -> Column:
        digit = F.lpad(F.lower(F.hex(F.pmod(state["n"], r.cast("long")))), 2, "0")
        return F.struct(F.floor((state["n"] - F.pmod(state["n"], r.cast("long"))) / r).cast("long").alias("n"), F.concat(digit, state["out"]).alias("out"))

    return F.rpad(F.aggregate(F.reverse(radices), start, step, lambda s: s["out"]), 128, "0")


def _ranked(rows: DataFrame, by: str, key: str) -> DataFrame:
    """``rows`` with their ``rank`` in (type, form), from 0, by a keyed hash; counted in 256 shares
    of a form, so no form is one task."""
    rows = rows.withColumn("__hash", F.sha2(F.concat_ws("|", F.lit(key), F.lit("rest"), by), 256))
    rows = stage(rows.withColumn("__share", F.substring("__hash", 1, 2)), "rest_shares")
    before = F.sum("n").over(Window.partitionBy("type", "form").orderBy("__share")) - F.col("n")
    shares = rows.groupBy("type", "form", "__share").agg(F.count("*").alias("n"))
    shares = shares.select("type", "form", "__share", before.alias("__before"))
    within = F.row_number().over(Window.partitionBy("type", "form", "__share").orderBy("__hash", by)) - 1
    ranked = rows.withColumn("rank", within).join(shares, ["type", "form", "__share"])
    return ranked.withColumn("rank", F.col("rank") + F.col("__before")).drop("__hash", "__share", "__before")


def assign_rest(pending: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """``taken`` and a surrogate for each pending entity, from the unused ones of its form.

    A form is what has the same places to fill.  As many of its surrogates are listed as it has
    entities and some more, so some are unused unless all are; the pending entities and those are
    joined by rank.  Entities that meet themselves rotate their surrogates; a single one takes a
    spare surrogate, or that of another entity, which takes this one.
    """
    in_form = ["type", "form"]
    columns = ["type", "canonical", "surrogate", "n_rows"]
    kind, canonical = F.col("type"), F.col("canonical")
    form = surrogate(kind, canonical, key, TRIES - 1, F.lit("0" * 128)).alias("form")
    left = stage(pending.select("type", "canonical", "n_rows", form), "rest")
    forms = left.groupBy(in_form).agg(F.count("*").alias("p"), F.min("canonical").alias("canonical"))
    known = stage(taken.select(*columns, form).join(forms.select(in_form), in_form, "left_semi"), "rest_taken")
    forms = forms.join(known.groupBy(in_form).agg(F.count("*").alias("u")), in_form, "left")
    forms = forms.withColumn("radices", _radices(kind, canonical))
    size = F.aggregate("radices", F.lit(1.0), lambda a, r: a * r)
    forms = forms.withColumn("m", F.least(size, F.coalesce("u", F.lit(0)) + 2 * F.col("p") + 1).cast("long"))
    block = 4096
    blocks = forms.withColumn("at", F.explode(F.expr(f"sequence(0L, (m - 1) div {block})"))).repartition("type", "form", "at")
    listed = blocks.withColumn("n", F.explode(F.expr(f"sequence(at * {block}, least(m, (at + 1) * {block}) - 1)")))
    made = surrogate(kind, canonical, key, TRIES - 1, _digest_of(F.col("n"), F.col("radices"))).alias("surrogate")
    used = taken.select("type", "surrogate")
    unused = _ranked(listed.select("type", "form", made).join(used, ["type", "surrogate"], "left_anti"), "surrogate", key)
    unused = stage(unused, "rest_unused")
    pairs = stage(_ranked(left, "canonical", key).join(unused, [*in_form, "rank"]).select(*in_form, *columns[1:], "rank"), "rest_pairs")
    if pairs.count() < left.count():
        raise ValueError("an entity type has more entities than its form has surrogates")
    same = stage(_ranked(pairs.filter("surrogate = canonical").drop("rank"), "canonical", key), "rest_same")
    good = pairs.filter("surrogate <> canonical").drop("rank")
    if same.isEmpty():
        return taken.unionByName(good.select(columns))
    same = stage(same.join(same.groupBy(in_form).agg(F.count("*").alias("k")), in_form), "rest_counted")
    many = same.filter("k > 1").withColumn("rank", F.pmod(F.col("rank") + 1, F.col("k")))
    others = same.select(*in_form, "rank", F.col("surrogate").alias("other"))
    rotated = many.join(others, [*in_form, "rank"]).withColumn("surrogate", F.col("other"))
    one = same.filter("k = 1").select(*in_form, F.col("canonical").alias("own"), F.col("n_rows").alias("own_rows"))
    spare = unused.join(pairs.select(*in_form, "rank"), [*in_form, "rank"], "left_anti")
    nobody = F.lit(None).cast("string").alias("canonical")
    offers = spare.select(*in_form, F.lit(0).alias("order"), "surrogate", nobody, F.lit(0).cast("long").alias("n_rows"))
    holders = known.unionByName(good).select(*in_form, F.lit(1).alias("order"), "surrogate", "canonical", "n_rows")
    offer = offers.unionByName(holders).join(one.select(in_form), in_form, "left_semi").groupBy(in_form)
    offer = offer.agg(F.min(F.struct("order", "surrogate", "canonical", "n_rows")).alias("by"))
    swapped = stage(one.join(offer, in_form, "left"), "rest_swapped")
    if not swapped.filter("by is null").isEmpty():
        raise ValueError("an entity type has more entities than its form has surrogates")
    gets = swapped.select("type", F.col("own").alias("canonical"), F.col("by.surrogate").alias("surrogate"), F.col("own_rows").alias("n_rows"))
    gives = swapped.filter("by.canonical is not null").select("type", F.col("by.canonical").alias("canonical"), F.col("own").alias("surrogate"), F.col("by.n_rows").alias("n_rows"))
    kept = taken.unionByName(good.select(columns)).join(gives.select("type", "canonical"), ["type", "canonical"], "left_anti")
    return stage(kept.select(columns).unionByName(rotated.select(columns)).unionByName(gets).unionByName(gives), "rest_assigned")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``(type, canonical, surrogate, n_rows)`` for a stored table of distinct entities.

    A candidate is taken by the first entity, in order, that it is made for, if it is no entity
    and not taken before; the rest try again.  After ``TRIES_BESIDE_ENTITIES`` rounds (a form with
    more entities than unused numbers) an entity's form may be used; after ``TRIES`` the rest is
    assigned by ``assign_rest``.
    """
    # these are no entities by themselves: no two need differ
    free = F.col("type").isin("initial", "particle")
    plain = entities.filter(free)
    plain = plain.select("type", "canonical", surrogate(F.col("type"), F.col("canonical"), key, 0).alias("surrogate"), "n_rows")
    entities = entities.filter(~free)
    taken, pending = None, entities
    for attempt in range(TRIES):
        made = pending.withColumn("surrogate", surrogate(F.col("type"), F.col("canonical"), key, attempt))
        made = stage(made, "candidates")
        owners = made.groupBy("type", "surrogate").agg(F.min("canonical").alias("canonical"))
        good = made.join(owners, ["type", "surrogate", "canonical"])
        if attempt < TRIES_BESIDE_ENTITIES:
            used = entities.select("type", F.col("canonical").alias("surrogate"))
            good = good.join(used, ["type", "surrogate"], "left_anti")
        else:
            good = good.filter("surrogate <> canonical")
        if taken is not None:
            good = good.join(taken, ["type", "surrogate"], "left_anti")
        good = stage(good.select("type", "canonical", "surrogate", "n_rows"), "surrogates")
        taken = good if taken is None else taken.unionByName(good)
        left = made.join(good, ["type", "canonical"], "left_anti").select(entities.columns)
        pending = stage(left, "pending")
        release(made)
        if pending.isEmpty():
            return taken.unionByName(plain)
    return assign_rest(pending, taken, key).unionByName(plain)


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with column ``text`` replaced and a last column ``n_replaced``, as a long.

    Null texts stay null, texts without entities stay as they are, both with 0 replaced.  Ids play
    no part: what belongs together is known by the text, so null or repeated ids do no harm.  An
    empty table gives an empty table.  All other columns are kept, whatever their names; one
    named ``n_replaced`` is replaced.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text).cast("string").alias("text"))
    keyed = rows.withColumn("key", F.xxhash64("text"))
    occurrence = F.explode(F.array_distinct(find(F.col("text")))).alias("occurrence")
    # (key, occurrence) is counted before it is shuffled, so copies of a text add nothing
    found = keyed.select("key", occurrence).groupBy("key", "occurrence").agg(F.count("*").alias("n_texts"))
    found = found.withColumn("kind", _type(F.col("occurrence")))
    found = stage(found, "occurrences")
    said = F.when(F.col("kind") == "name", gender(F.col("occurrence"))).alias("gender")
    split_up = found.select(
        "key", "occurrence", "kind", said, F.posexplode(parts(F.col("occurrence"), F.col("kind"))).alias("at", "entity")
    )
    times = [F.count(F.when(F.col("gender") == g, 1)).alias(g) for g in ("f", "m")]
    entities = split_up.groupBy("entity").agg(F.count("*").alias("n_rows"), *times).select("entity.*", "n_rows", "f", "m")
    given = F.when(F.col("f") > F.col("m"), "given_f").when(F.col("m") > F.col("f"), "given_m").otherwise("given_n")
    entities = entities.withColumn("type", F.when(F.col("type") == "given", given).otherwise(F.col("type")))
    assigned = assign(stage(entities.drop("f", "m"), "entities"), key)
    type_ = F.when(F.col("type").startswith("given_"), "given").otherwise(F.col("type")).alias("type")
    assigned = stage(assigned.select(F.struct(type_, "canonical").alias("entity"), "surrogate", "n_rows"), "assigned")
    with_surrogate = stage(join_per_key(split_up.drop("gender"), assigned, "entity", "n_rows"), "rendered_parts")
    in_order = F.array_sort(F.collect_list(F.struct("at", "surrogate")))["surrogate"]
    rendered = with_surrogate.groupBy("key", "occurrence", "kind").agg(in_order.alias("found"))
    rendered = rendered.select("key", "occurrence", _rendered(F.col("occurrence"), F.col("kind"), F.col("found")).alias("by"), F.lit(False).alias("bare"))
    # a name's words, where they stand alone in its text; a surname goes before a given name
    word = F.get(_words(F.col("occurrence")), F.col("at"))
    alone = with_surrogate.filter("entity.type in ('surname', 'given')").select(
        "key", word.alias("occurrence"), F.struct(F.col("entity.type") != "surname", F.initcap("surrogate").alias("by")).alias("by")
    )
    alone = alone.groupBy("key", "occurrence").agg(F.min("by")["by"].alias("by"), F.lit(True).alias("bare"))
    pairs = F.map_from_entries(F.collect_list(F.struct("occurrence", "by")))
    names = F.array_join(F.sort_array(F.collect_list(F.when(F.col("bare"), F.col("occurrence"))), asc=False), "|")
    per_text = rendered.unionByName(alone).groupBy("key").agg(pairs.alias("by"), names.alias("names"))
    n_rows = found.groupBy("key").agg(F.max("n_texts").alias("n_rows"))
    per_text = stage(per_text.join(n_rows, "key"), "replacements")

    with_names = F.concat(F.lit(PATTERN + r"|(?<![\p{L}\d])(?:"), F.col("names"), F.lit(r")(?![\p{L}\d])"))
    holds_names = F.col("names") != ""
    replaced = F.array_join(
        F.zip_with(
            F.when(holds_names, F.split("text", with_names, -1)).otherwise(F.split("text", PATTERN, -1)),
            F.transform("matches", lambda m: F.element_at("by", m)),
            lambda piece, by: F.concat(piece, F.coalesce(by, F.lit(""))),
        ),
        "",
    )
    matches = keyed.withColumn("matches", find(F.col("text")))
    holds = F.coalesce(F.size("matches"), F.lit(0)) > 0
    with_map = join_per_key(matches.filter(holds), per_text, "key", "n_rows")
    every = F.when(holds_names, F.regexp_extract_all(F.col("text"), with_names, F.lit(0))).otherwise(F.col("matches"))
    with_map = with_map.withColumn("matches", every)
    changed = with_map.select("row", replaced.alias("text"), F.size("matches").cast("long").alias("n_replaced"))
    same = matches.filter(~holds).select("row", "text", F.lit(0).cast("long").alias("n_replaced"))
    both = changed.unionByName(same)
    columns = [F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns if c != "n_replaced"]
    return both.select(*columns, "n_replaced")
