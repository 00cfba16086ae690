"""Replace personal data by keyed surrogates of the same type, gender, script and format.

One pattern finds e-mail and IP addresses, phone and card numbers, IBANs, social security
numbers, MAC addresses, secrets, and names after a title. What is found is normalised (digits
only, lower case, no blanks), so that the same number or name in another notation is the same
entity. An entity's surrogate is drawn by a hash of the key, its type and its normal form:

* digits, letters and their case and script stay in their places, separators are kept;
* cards and the country digit of phones keep their first digit, cards their Luhn check, e-mail
  addresses their last label, IBANs their country, addresses are valid addresses;
* given names follow the title's gender and the name's script, family names the script; a name
  in another script than Latin or Cyrillic has its letters drawn from its own script.

A name is found after a title. The words of the names so found are then replaced in the rest of
the same text as well, wherever they stand as capitalised words, each counted as a name; a
word that is a given and a family name there counts as family name. A person without a title
in the whole text, and a name in a script without capitals, are not found.

No two entities of a type get the same surrogate, and none gets what is a real entity of the
type in the corpus: clashes are looked up for the whole table, the smallest keeps its
surrogate and the others draw again. The same entity has the same surrogate everywhere, and
the same key gives the same surrogates in every run over the same corpus.

Only built-in functions are used. Texts without a match pass unchanged, null texts stay null.
Repeated rows are replaced alike. Other columns are not read. An empty table gives an empty
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcraft.sources.staging import cut_lineage

MAX_DRAWS = 40

# Titles by gender, and names by gender and script.
MALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "Г-н", "Господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Госпожа"]
NEUTRAL_TITLES = ["Dr", "Prof"]
GIVEN = {
    "given_m_latin": ["adrian", "bruno", "carl", "dario", "emil", "felix", "gustav", "hugo", "ivo", "jonas", "karim",
                      "leo", "marco", "nils", "oscar", "pablo", "quentin", "robin", "simon", "theo", "urban", "victor"],
    "given_f_latin": ["alma", "bianca", "clara", "diana", "elena", "flora", "greta", "hanna", "irene", "julia", "karla",
                      "lucia", "marta", "nora", "olivia", "paula", "rosa", "sofia", "tessa", "ursula", "vera", "wilma"],
    "given_n_latin": ["alex", "andrea", "chris", "dominique", "jules", "kim", "lou", "maxime", "noa", "robin", "sam",
                      "toni"],
    "given_m_cyrillic": ["антон", "борис", "виктор", "глеб", "денис", "егор", "иван", "кирилл", "максим", "олег"],
    "given_f_cyrillic": ["анна", "вера", "галина", "дарья", "елена", "ирина", "лидия", "мария", "ольга", "софия"],
    "given_n_cyrillic": ["женя", "саша", "валя", "слава"],
}
FAMILY = {
    "family_latin": (["ba", "cor", "dal", "fer", "gar", "hol", "jan", "kel", "lin", "mar", "nor", "pal", "ros", "sal"],
                     ["ba", "de", "ga", "ko", "li", "mo", "na", "ro", "ti", "vi"],
                     ["ner", "sen", "man", "rez", "ton", "ley", "din", "bert"]),
    "family_cyrillic": (["бар", "вол", "гор", "дан", "кор", "лап", "мор", "пол", "сав", "тар"],
                        ["а", "е", "и", "о", "ма", "ни", "ро"], ["венко", "дзе", "ренко", "стых", "ченко"]),
}

_TITLE = "(?:" + "|".join(sorted(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES, key=len, reverse=True)) + r")\.?"
# A possessive 's is no part of the name.
_NAME = r"\p{Lu}(?:[\p{L}\p{M}]|['’](?=\p{L}{2}))+"
_MENTION = rf"(?<![\p{{L}}\p{{M}}'’]){_NAME}|(?<=\p{{L}}['’]){_NAME}"
# Letters of an address; scripts written without blanks would run into it.
_ADDRESS = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]]"
GREEK = "αβγδεζηθικλμνξοπρστυφχψω"
PATTERNS = {
    "email": rf"(?:{_ADDRESS}|_)(?:(?:{_ADDRESS}|[._%+-]){{0,62}}(?:{_ADDRESS}|_))?@"
             rf"{_ADDRESS}(?:(?:{_ADDRESS}|[.-]){{0,250}}{_ADDRESS})?\.(?:[A-Za-z]{{2,24}}|{_ADDRESS}{{2,24}})",
    "mac": r"(?<![\w:])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![\w:])",
    "secret": r"(?<!\w)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?!\w)"
              r"|(?<=[=:] {0,2}[\"'])[A-Za-z0-9_/+=-]{16,256}(?=[\"'])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.+-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "phone": r"(?<![\w.+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
             r"|(?<![\w.])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    "name": rf"(?<!\p{{L}}){_TITLE} {_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Cheap test that every match passes.
_MAYBE = rf"[0-9@]|[=:] {{0,2}}[\"'][A-Za-z0-9_/+=-]{{16}}|sk-[A-Za-z0-9]{{20}}|{_TITLE} \p{{Lu}}|[a-fA-F]{{32}}"
# Characters that the normal form leaves out, by type.
_DROPPED = {"phone": r"\D", "card": r"\D", "ssn": r"\D", "iban": r"[^A-Z0-9]", "mac": r"[^0-9A-Fa-f]"}


def found(text: Column) -> Column:
    """All matches in the order of the text."""
    return F.when(text.rlike(_MAYBE), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def _type_of(match: Column) -> Column:
    out = F.lit("name")
    # A secret in quotes may be made of anything, so it is the last to be considered.
    for kind in ["secret", *reversed([k for k in PATTERNS if k not in ("name", "secret")])]:
        # Look-arounds saw the neighbours when the match was found; alone, it must fit whole.
        bare = PATTERNS[kind].replace(r"(?<=[=:] {0,2}[\"'])", "").replace(r"(?=[\"'])", "")
        out = F.when(match.rlike(rf"\A(?:{bare})\z"), F.lit(kind)).otherwise(out)
    return out


def _lowered(text: Column) -> Column:
    """Lower case of the same length: the dotted capital I alone would become two characters."""
    return F.lower(F.translate(text, "İ", "I"))


def _parts(match: Column, kind: Column) -> Column:
    """Parts of a match that have a surrogate of their own: (type, normal form, surface)."""
    title = F.regexp_extract(match, rf"\A({_TITLE}) ", 1)
    name = F.regexp_replace(match, rf"\A{_TITLE} ", "")
    script = F.when(name.rlike(r"\A\p{IsCyrillic}"), "_cyrillic").when(
        name.rlike(r"\A\p{IsLatin}"), "_latin").otherwise("_other")
    bare = F.regexp_replace(title, r"\.$", "")
    gender = F.when(bare.isin(MALE_TITLES), "m").when(bare.isin(FEMALE_TITLES), "f").otherwise("n")
    words = F.split(name, " ")

    def part(type_: Column, surface: Column, normal: Column) -> Column:
        return F.struct(type_.alias("type"), normal.alias("normal"), surface.alias("surface"))

    family = part(F.concat(F.lit("family"), script), F.element_at(words, -1), _lowered(F.element_at(words, -1)))
    given = part(F.concat(F.lit("given_"), gender, script), words[0], _lowered(words[0]))
    names = F.when(F.size(words) > 1, F.array(given, family)).otherwise(F.array(family))
    normal = F.when(kind.isin("secret", "ip"), match).otherwise(_lowered(match))
    for type_, dropped in _DROPPED.items():
        normal = F.when(kind == type_, F.regexp_replace(match if type_ != "mac" else _lowered(match), dropped, "")
                        ).otherwise(normal)
    return F.when(kind == "name", names).otherwise(F.array(part(kind, match, normal)))


def _number(seed: Column, place: Column | str) -> Column:
    """A number that the seed and the place determine."""
    hex_digits = F.substring(F.md5(F.concat(seed, F.lit(":"), place if isinstance(place, Column) else F.lit(place))), 1, 8)
    return F.conv(hex_digits, 16, 10).cast("long")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _letter(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), (number % len(alphabet) + 1).cast("int"), F.lit(1))


def _own_script(c: Column, number: Column) -> Column:
    """Another letter of a letter's script: of Greek, or of the 64 code points around it."""
    lower, code = r"\A\p{Ll}\z", F.ascii(c)
    first = code - code % 64
    around = F.transform(F.sequence(first, first + 63), lambda p: F.decode(
        F.unhex(F.lpad(F.hex(p), 8, "0")), "UTF-32"))
    letters = F.filter(around, lambda x: x.rlike(r"\A\p{L}\z") & (x.rlike(lower) == c.rlike(lower))
                       & (F.length(F.upper(x)) == 1) & (F.lower(F.upper(x)) == x))
    drawn = F.transform(F.array(letters), lambda x: F.when(
        F.size(x) > 0, F.element_at(x, (number % F.greatest(F.size(x), F.lit(1)) + 1).cast("int"))).otherwise(c))[0]
    return F.when(c.rlike(r"\p{IsGreek}"), _letter(GREEK, number)).otherwise(drawn)


def _drawn_character(c: Column, number: Column, kind: Column) -> Column:
    hexadecimal = F.when(c.rlike("[0-9a-f]"), _letter("0123456789abcdef", number)).otherwise(
        _letter("0123456789ABCDEF", number))
    free = (F.when(c.rlike("[0-9]"), _letter("0123456789", number))
            .when(c.rlike("[a-z]"), _letter("abcdefghijklmnopqrstuvwxyz", number))
            .when(c.rlike("[A-Z]"), _letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", number))
            .when(c.rlike(r"\p{L}"), _own_script(c, number)).otherwise(c))
    return F.when((kind == "hex") & c.rlike("[0-9a-fA-F]"), hexadecimal).otherwise(free)


def _luhn(digits: Column, length: Column) -> Column:
    """Luhn sum of a string of digits."""
    places = F.sequence(F.lit(1), length)
    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((length - i) % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b)


def _drawn(kind: Column, normal: Column, key: str, draw: int) -> Column:
    """Surrogate of a normal form at its `draw`-th attempt."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, normal, F.lit(str(draw))), 256)
    length = F.length(normal)
    kept_head = F.when(kind.isin("card", "phone"), 1).when(kind == "iban", 2).otherwise(0)
    kept_tail = F.when(kind == "email", F.length(F.substring_index(normal, ".", -1))).otherwise(0)
    style = F.when((kind == "mac") | ((kind == "secret") & normal.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z")), "hex").otherwise("free")
    def character(i: Column) -> Column:
        c = F.substring(normal, i, F.lit(1))
        return F.when((i <= kept_head) | (i > length - kept_tail), c).otherwise(
            _drawn_character(c, _number(seed, i.cast("string")), style))
    plain = F.array_join(F.transform(F.sequence(F.lit(1), length), character), "")
    # One expression each, so that the drawn characters are not drawn again for every use.
    plain_card = F.transform(F.array(plain), lambda p: F.concat(
        F.substring(p, F.lit(1), length - 1),
        ((10 - _luhn(F.concat(F.substring(p, F.lit(1), length - 1), F.lit("0")), length) % 10) % 10).cast("string")))[0]
    card = F.when(_luhn(normal, length) % 10 == 0, plain_card).otherwise(plain)
    ip = F.concat_ws(".", (1 + _number(seed, "a") % 223).cast("string"), (_number(seed, "b") % 256).cast("string"),
                     (_number(seed, "c") % 256).cast("string"), (1 + _number(seed, "d") % 254).cast("string"))
    out = F.when(kind == "card", card).when(kind == "ip", ip).otherwise(plain)
    for name, values in GIVEN.items():
        # A later attempt draws a double name, then longer ones.
        parts = [_pick(values, _number(seed, f"g{i}")) for i in range(1 + draw)]
        out = F.when(kind == name, F.concat_ws("-", *parts)).otherwise(out)
    for name, (first, middle, last) in FAMILY.items():
        parts = [_pick(first, _number(seed, "f"))]
        parts += [_pick(middle, _number(seed, f"m{i}")) for i in range(1 + draw)]
        out = F.when(kind == name, F.concat(*parts, _pick(last, _number(seed, "l")))).otherwise(out)
    return out


def surrogates(parts: DataFrame, key: str, max_draws: int = MAX_DRAWS) -> DataFrame:
    """(type, normal, surrogate) of the distinct (type, normal) of `parts`."""
    real = cut_lineage(parts.select("type", "normal").distinct(), "entities")
    taken = real.select("type", F.col("normal").alias("surrogate"))
    waiting, accepted = real, None
    for draw in range(max_draws):
        drawn = cut_lineage(waiting.withColumn(
            "surrogate", _drawn(F.col("type"), F.col("normal"), key, draw)), "drawn")
        free = drawn.join(taken, ["type", "surrogate"], "left_anti")
        won = cut_lineage(free.groupBy("type", "surrogate").agg(F.min("normal").alias("normal")).select(
            "type", "normal", "surrogate"), "won")
        accepted = won if accepted is None else accepted.unionByName(won)
        taken = taken.unionByName(won.select("type", "surrogate"))
        waiting = cut_lineage(waiting.join(won, ["type", "normal"], "left_anti"), "waiting")
        if waiting.isEmpty():
            return accepted
    # A small space may be full, or a letter may have no other of its kind: a prefix makes room.
    prefix = F.substring(F.sha2(F.concat_ws("|", F.lit(key), "type", "normal", F.lit("room")), 256), 1, 32)
    return accepted.unionByName(waiting.select("type", "normal", F.concat(
        prefix, F.lit("-"), _drawn(F.col("type"), F.col("normal"), key, max_draws)).alias("surrogate")))


def _as_surface(surrogate: Column, surface: Column, kind: Column) -> Column:
    """The surrogate in the notation of the surface."""
    def place(i: Column) -> Column:
        c, before = F.substring(surface, i, F.lit(1)), F.substring(surface, F.lit(1), i)
        kept, at = F.lit(True), i
        for type_, dropped in _DROPPED.items():
            kept = F.when(kind == type_, ~c.rlike(dropped)).otherwise(kept)
            at = F.when(kind == type_, F.length(F.regexp_replace(before, dropped, ""))).otherwise(at)
        new = F.substring(surrogate, at, F.lit(1))
        return F.when(~kept, c).when(c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new)
    walked = F.array_join(F.transform(F.sequence(F.lit(1), F.length(surface)), place), "")
    named = F.when((F.upper(surface) == surface) & (F.length(surface) > 1), F.upper(surrogate)).otherwise(
        F.array_join(F.transform(F.split(surrogate, "-"), lambda w: F.initcap(w)), "-"))
    is_name = kind.startswith("given_") | kind.startswith("family_")
    longer = F.length(surrogate) > F.length(surface)  # drawn from a larger space than the notation has
    return F.when(is_name, named).when(kind.isin("secret", "ip") | longer, surrogate).otherwise(walked)


def replace_entities(docs: DataFrame, key: str, *, doc_id: str = "doc_id", text: str = "text",
                     max_draws: int = MAX_DRAWS) -> DataFrame:
    """(doc_id, n_entities, types, text), one row per row: `types` of the entities in order."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    matched = source.withColumn("matches", F.coalesce(found(F.col("text")), F.array().cast("array<string>")))
    clean = matched.where(F.size("matches") == 0).select(
        "doc_id", F.lit(0).cast("long").alias("n_entities"), F.array().cast("array<string>").alias("types"), "text")
    private = cut_lineage(matched.where(F.size("matches") > 0).withColumn(
        "row", F.monotonically_increasing_id()), "matched")

    places = private.select("row", F.posexplode("matches").alias("place", "match"))
    kinds = places.select("match").distinct().withColumn("kind", _type_of(F.col("match")))
    parts = cut_lineage(kinds.select("match", "kind", F.posexplode(_parts(F.col("match"), F.col("kind"))).alias(
        "nr", "part")).select("match", "kind", "nr", "part.*"), "parts")
    known = surrogates(parts, key, max_draws)
    new = parts.join(known, ["type", "normal"]).withColumn(
        "new", _as_surface(F.col("surrogate"), F.col("surface"), F.col("type")))
    # A match has one or two parts; a name keeps its title.
    whole = new.groupBy("match", "kind").agg(F.array_sort(F.collect_list(F.struct("nr", "new"))).alias("news"))
    title = F.when(F.col("kind") == "name", F.regexp_extract("match", rf"\A{_TITLE} ", 0)).otherwise("")
    whole = whole.select("match", "kind", F.concat(title, F.array_join(F.col("news.new"), " ")).alias("new"))
    by_row = places.join(whole, "match").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("place", "kind", "new"))).alias("news"))
    # The words of a text's names, as they are written in the text between the matches.
    named = places.join(parts.where(F.col("kind") == "name").select("match", "type", "normal"), "match").groupBy(
        "row", "normal").agg(F.min("type").alias("type"))
    between = private.select("row", F.split("text", ANY, -1).alias("between"))
    written = between.join(named.select("row").distinct(), "row", "left_semi").select(
        "row", F.explode(F.array_distinct(F.flatten(F.transform(
            "between", lambda t: F.regexp_extract_all(t, F.lit(_MENTION), F.lit(0)))))).alias("word"))
    mentions = written.withColumn("normal", _lowered(F.col("word"))).join(named, ["row", "normal"]).join(
        known, ["type", "normal"]).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct(
            "word", _as_surface(F.col("surrogate"), F.col("word"), F.col("type")).alias("new")))).alias("mentions"))

    def rewritten(t: Column) -> Column:
        news = F.transform(F.regexp_extract_all(t, F.lit(_MENTION), F.lit(0)), lambda w: F.struct(
            w.alias("word"), F.try_element_at("mentions", w).alias("new")))
        pieces = F.zip_with(F.split(t, _MENTION, -1), news, lambda gap, w: F.concat(
            gap, F.coalesce(w["new"], w["word"], F.lit(""))))
        return F.struct(F.array_join(pieces, "").alias("text"),
                        F.size(F.filter(news, lambda w: w["new"].isNotNull())).alias("n"))

    unchanged = F.transform("between", lambda t: F.struct(t.alias("text"), F.lit(0).alias("n")))
    written_anew = F.when(F.col("mentions").isNull(), unchanged).otherwise(F.transform("between", rewritten))
    joined = private.join(by_row, "row").join(mentions, "row", "left").withColumn(
        "between", F.split("text", ANY, -1)).withColumn("between", written_anew)
    woven = F.zip_with("between", "news", lambda a, b: F.concat(a["text"], F.coalesce(b["new"], F.lit(""))))
    types = F.flatten(F.zip_with("between", "news", lambda a, b: F.concat(
        F.array_repeat(F.lit("name"), a["n"]), F.filter(F.array(b["kind"]), lambda k: k.isNotNull()))))
    replaced = joined.select("doc_id", types.alias("types"), F.array_join(woven, "").alias("text")).select(
        "doc_id", F.size("types").cast("long").alias("n_entities"), "types", "text")
    return clean.unionByName(replaced)
