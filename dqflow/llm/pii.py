"""Personal data: detected entities receive keyed, type-consistent surrogates; DataFrame functions only.

Detection is one regular expression of all kinds.  A surrogate is drawn from a keyed SHA-512 of
the entity, so it cannot be reversed without the key, and has the type and format of what it
replaces: digits for digits, letters for letters, the same separators and case; a card, which is
one only by its check digit, keeps its network digit and a valid check digit; an address of the internet comes from a reserved
block; mail goes to the reserved top-level domain ``example``; an IBAN has valid check digits; a name keeps title, gender and
script.  A name is found by its title; its words are then replaced wherever they stand in the same document as
words of their own, with a capital, with or without a title.  Entities are compared in a normal form (mail in lower case, numbers as digits, names
word by word), so one entity gets one surrogate in all its spellings and documents.

All distinct entities of the corpus are checked against each other: a surrogate that two would
share, or that is itself an entity of the corpus, is drawn again by all but the smallest, until
none is left; where an entity's format has few values, as in a mail address of two letters, its
surrogate grows with each draw.  These tables are keyed by entity and written to the shared folder.  Only documents
that may hold an entity are shuffled, to meet their surrogates; a hot entity is one row on one side of that
join and a splittable key on the other.

Defined cases: null text stays null and has no entities; repeated rows are each rewritten; rows
with a null id are told apart by their texts; an empty table gives an empty result; further
columns stay as they are, columns of the operator's names give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqflow.llm.frames import col, kept, quoted
from dqflow.session import scratch_path

#: Replace it with a secret of your own; equal keys give equal surrogates.
DEFAULT_KEY = "set-your-own-key"
#: No format that does not grow has so few values that this many draws find none.
MAX_DRAWS = 200
#: Where a word begins or ends.
_EDGE = r"(?<=[\p{L}\p{M}'’-])(?![\p{L}\p{M}'’-])|(?<![\p{L}\p{M}'’-])(?=[\p{L}\p{M}'’-])"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLES = {
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "г-н", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mlle", "г-жа", "госпожа"),
    "n": ("Dr", "Dra", "Prof", "Doctor", "Professor", "Mx", "д-р", "доктор", "профессор"),
}
_TITLE = "(?:" + "|".join(sorted((t for ts in _TITLES.values() for t in ts), key=len, reverse=True)) + ")"
_HEAD = rf"(?:{_TITLE}\.? )+"
_WORD = r"\p{Lu}[\p{L}\p{M}]*(?:['’-]\p{L}[\p{L}\p{M}]*)*"
_NAME = rf"(?:(?:\p{{Lu}}\.-?)+(?:{_WORD})?|{_WORD})"
_MAIL = r"[\p{L}\p{M}\p{N}._%+-]"
#: Patterns by kind, tried in this order where several match at one place.
PATTERNS = {
    "email": rf"(?<!{_MAIL}){_MAIL}{{1,64}}+@(?:[\p{{L}}\p{{M}}\p{{N}}-]{{1,63}}\.){{1,8}}\p{{L}}[\p{{L}}\p{{M}}]{{1,23}}(?![\p{{L}}\p{{M}}\p{{N}}-])",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w)(?!\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.+-])[2-6](?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
             r"|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)"
             r"|(?<![\w.-])\d{3}(?<s>[ .-])\d{3}\k<s>\d{4}(?![\w-])"
             r"|(?<![\w.+-])1[ .-]\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?![\w-])"
             # Trunk prefix; nine digits at least, so dates are none.
             r"|(?<![\w.+/-])(?=0(?:[ ./-]?\d){8,11}(?![\w-]))0\d{1,4}(?:(?<t>[ .-])\d{2,4}(?:\k<t>\d{2,4}){1,4}|[ /-]\d{5,8})(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "person": rf"(?<!\p{{L}}){_HEAD}{_NAME}(?: {_NAME})*(?!\p{{L}})",
}
KINDS = tuple(PATTERNS)
#: What any text with an entity has: a digit, "@" or a title.
MAYBE = "[0-9@]"
DETECT = "|".join(PATTERNS.values())

#: Given names by gender and script (fixed values), and syllables of family names.
_GIVEN = {
    ("m", "latin"): "Adam Boris Carl David Erik Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul",
    ("f", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Klara Lena Maria Nora Olga Paula",
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Фёдор",
    ("f", "cyrillic"): "Анна Вера Галина Дарья Ева Жанна Зоя Инна Карина Лариса Мария Нина Ольга Полина Софья Юлия",
}
for _script in ("latin", "cyrillic"):
    _GIVEN["n", _script] = _GIVEN["m", _script] + " " + _GIVEN["f", _script]
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa se so ta te to va ve vo za ze zo",
    "cyrillic": "ба бе бо ва ве во га го да де до жа за зе зо ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те то",
}


def _quoted(words: str) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words.split()) + ")"


def _found(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(DETECT), F.lit(0))


def _maybe(text: Column) -> Column:
    """Whether a text can hold an entity; cheap, so that the detection runs on few texts."""
    out = text.rlike(MAYBE)
    for title in (t for ts in _TITLES.values() for t in ts):
        out = out | text.contains(f"{title} ") | text.contains(f"{title}. ")
    return F.coalesce(out, F.lit(False))


def _card(m: Column) -> Column:
    """The first run of a match's groups of digits that is a card by its check digit; null if none is."""
    groups = F.split(m, "(?<=[ -])")
    n = F.size(groups)
    run = lambda i: F.transform(F.sequence(n - i, F.lit(1), F.lit(-1)), lambda k: F.rtrim(F.array_join(F.slice(groups, i + 1, k), ""), F.lit(" -")))
    digits = lambda t: F.regexp_replace(t, "[^0-9]", "")
    valid = lambda t: t.rlike("^[2-6]([ -]?[0-9]){12,18}$") & (_luhn(digits(t)) % 10 == 0)
    return F.get(F.filter(F.flatten(F.transform(F.sequence(F.lit(0), n - 1), run)), valid), F.lit(0))


def _kind_column(m: Column) -> Column:
    """The kind of a match; "none" is a long number that is no card and has no other number in it."""
    return (F.when(m.contains("@"), "email").when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ip")
            .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn").when(m.rlike("^[A-Z]{2}[0-9]{2}"), "iban")
            .when(m.rlike(r"^\p{L}"), "person").when(~m.rlike("^[2-6]([ -]?[0-9]){12,18}$"), "phone")
            .when(_card(m).isNotNull(), "card").when(m.rlike(PATTERNS["phone"] + "|" + PATTERNS["ssn"]), "phone").otherwise("none"))


def _entities(found: DataFrame) -> DataFrame:
    """(raw, kind, word, entity, norm): what a distinct match consists of, in normal form.

    ``entity`` is the kind of thing a surrogate is drawn for; names are drawn word by word."""
    raw, kind = F.col("raw"), F.col("kind")
    digits = F.regexp_replace(F.when(kind == "card", _card(raw)).otherwise(raw), "[^0-9]", "")
    names = F.split(F.regexp_replace(raw, f"^{_HEAD}", ""), " ")
    title = F.regexp_extract(raw, rf"^({_TITLE})", 1)
    gender = F.when(title.isin(*_TITLES["f"]), "f").when(title.isin(*_TITLES["n"]), "n").otherwise("m")
    script = lambda word: F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    # The last word is the family's, all before it are given names.
    person = F.transform(names, lambda word, i: F.struct(
        i.alias("word"), F.concat(F.when(i == F.size(names) - 1, "family_").otherwise(F.concat(F.lit("given_"), gender, F.lit("_"))), script(word)).alias("entity"),
        F.lower(word).alias("norm")))
    norm = (F.when(kind == "email", F.lower(raw)).when(kind == "ip", raw)
            .when(kind == "iban", F.replace(raw, F.lit(" "), F.lit("")))
            .when(kind == "phone", F.concat(F.when(raw.startswith("+"), F.concat(F.regexp_extract(raw, r"^\+(\d{1,3})", 1), F.lit("+"))).otherwise(""), digits))
            .otherwise(digits))
    whole = F.array(F.struct(F.lit(0).alias("word"), kind.alias("entity"), norm.alias("norm")))
    parts = F.when(kind == "person", person).otherwise(whole)
    return found.select("raw", "kind", F.explode(parts).alias("p")).select("raw", "kind", "p.*")


def _surrogate(key: str) -> Column:
    """Surrogate of (entity, norm) at draw ``draw``, in normal form."""
    hashed = [F.sha2(F.concat_ws("\x1f", F.lit(key), "entity", "norm", F.col("draw").cast("string"), F.lit(str(i))), 512) for i in range(3)]
    bytes_ = F.transform(F.sequence(F.lit(0), F.lit(191)), lambda i: F.conv(F.substr(F.concat(*hashed), i * 2 + 1, F.lit(2)), 16, 10).cast("int"))

    def drawn(b: Column) -> Column:
        norm, entity = F.col("norm"), F.col("entity")
        at = lambda i: F.get(b, i % 192)

        def mapped(text: Column) -> Column:
            """Digits to digits and letters to letters."""
            one = lambda c, i: (F.when(c.rlike("[0-9]"), (at(i) % 10).cast("string"))
                                .when(c.rlike("[a-z]"), F.char(at(i) % 26 + 97)).when(c.rlike("[A-Z]"), F.char(at(i) % 26 + 65))
                                .when(c.rlike(r"[\p{L}\p{M}\p{N}]"), F.char(at(i) % 26 + 97)).otherwise(c))
            return F.array_join(F.transform(F.split(text, ""), one), "")

        # A country's code before "+" stays; a number does not begin with 0 unless it did.
        code = F.substring_index(norm, "+", 1)
        number = F.when(norm.contains("+"), F.substring_index(norm, "+", -1)).otherwise(norm)
        local = F.when(norm.contains("+"), F.substr(number, F.length(code) + 1, F.lit(64))).otherwise(number)
        lead = F.when(F.substring(local, 1, 1) == "0", "0").otherwise((at(F.lit(190)) % 8 + 2).cast("string"))
        phone = F.concat(F.when(norm.contains("+"), F.concat(code, F.lit("+"), code)).otherwise(""), lead,
                         F.substr(mapped(local), F.lit(2), F.lit(64)))
        body = F.concat(F.substring(norm, 1, 1), F.substr(mapped(norm), F.lit(2), F.length(norm) - 2))
        card = F.when(_luhn(norm) % 10 == 0, F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))) \
            .otherwise(F.concat(body, (at(F.lit(191)) % 10).cast("string")))
        user, host = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
        label = F.regexp_replace(host, r"\.[^.]*$", "")
        every = mapped(F.concat(user, F.call_function("repeat", F.lit("x"), F.greatest(F.col("draw") - 1, F.lit(0))), F.lit("@"), label))
        account = F.substr(mapped(norm), F.lit(5), F.length(norm))
        check = F.lpad((98 - _mod97(F.concat(account, F.substring(norm, 1, 2), F.lit("00")))).cast("string"), 2, "0")
        octets = [F.when(F.col("draw") < 8, at(F.lit(0)) % 15 + 240).otherwise(at(F.lit(0)) % 223 + 1), *(at(F.lit(i)) for i in (1, 2, 3))]
        out = (F.when(entity == "email", F.concat(every, F.lit(".example")))
               .when(entity == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
               .when(entity == "ssn", F.when(F.col("draw") < 8, F.concat(F.lit("9"), F.substr(mapped(norm), F.lit(2), F.lit(8)))).otherwise(mapped(norm)))
               .when(entity == "card", card).when(entity == "phone", phone)
               .when(entity == "iban", F.concat(F.substring(norm, 1, 2), check, account)))
        for script, syllables in _SYLLABLES.items():
            parts = F.expr(_quoted(syllables))
            name = F.array_join(F.transform(F.sequence(F.lit(1), F.least(F.col("draw") + 3, F.lit(60))), lambda i: F.get(parts, (at(i * 2) * 256 + at(i * 2 + 1)) % 40)), "")  # noqa: B023
            out = out.when(entity == f"family_{script}", name)
            more = F.when(F.col("draw") > 0, F.substr(name, F.lit(1), F.col("draw") * 2)).otherwise("")
            for gender in "mfn":
                given = F.get(F.expr(_quoted(_GIVEN[gender, script])), at(F.lit(0)) % len(_GIVEN[gender, script].split()))
                out = out.when(entity == f"given_{gender}_{script}", F.lower(F.concat(given, more)))
        return out

    return F.get(F.transform(F.array(bytes_), drawn), F.lit(0))


def _luhn(digits: Column) -> Column:
    """Sum of a number's digits, every second from the right doubled."""
    doubled = lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: doubled(c.cast("int"), i))
    return F.aggregate(each, F.lit(0), lambda n, d: n + d)


def _mod97(text: Column) -> Column:
    """A text of digits and capitals, letters read as 10 to 35, modulo 97."""
    step = lambda r, c: F.when(c.rlike("[0-9]"), r * 10 + c.cast("int")).otherwise(r * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _table(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(entity, norm, surrogate) of distinct (entity, norm): no two of an entity's kind share a
    surrogate, and no surrogate is one of the norms."""
    settled, waiting, draw = None, entities.withColumn("draw", F.lit(0)), 0
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        # Rows are small and drawing is not: a fixed number of tasks, not as few as their bytes need.  (By the
        # columns themselves, Spark would take the distinct entities' own shuffle for this one.)
        drawn = _table(waiting.repartition(tasks, F.xxhash64("norm", "entity")).withColumn("surrogate", _surrogate(key)), "pii-drawn")
        free = drawn.join(entities.select("entity", F.col("norm").alias("surrogate")), ["entity", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["entity", "surrogate"], "left_anti")
        first = free.groupBy("entity", "surrogate").agg(F.min("norm").alias("norm")).select("entity", "norm", "surrogate")
        settled = _table(first if settled is None else settled.unionByName(first), "pii-settled")
        waiting = _table(drawn.join(settled, ["entity", "norm"], "left_anti").select("entity", "norm", (F.col("draw") + 1).alias("draw")), "pii-waiting")
        draw += 1
        if not waiting.take(1):
            return settled
        if draw == MAX_DRAWS:
            raise RuntimeError("no free surrogates are left")


def _rendered(parts: DataFrame, drawn: DataFrame) -> DataFrame:
    """(raw, surrogate): the surrogates of a match's parts in the match's own format."""
    words = F.array_sort(F.collect_list(F.struct("word", "surrogate")))
    joined = parts.join(drawn, ["entity", "norm"]).groupBy("raw", "kind").agg(F.array_join(words["surrogate"], " ").alias("main"))
    raw, main = F.col("raw"), F.col("main")
    card = F.when(F.col("kind") == "card", _card(raw)).otherwise(raw)
    before = F.call_function("substring_index", raw, card, F.lit(1))
    digits = F.substring_index(main, "+", -1)
    filled = F.array_join(F.transform(F.split(card, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(digits, F.length(F.regexp_replace(F.substr(card, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))).otherwise(c)), "")
    filled = F.concat(before, filled, F.substr(raw, F.length(before) + F.length(card) + 1))
    spaced = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(c == " ", c).otherwise(
        F.substr(main, F.length(F.replace(F.substr(raw, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), "")
    upper = raw == F.upper(raw)
    head = F.regexp_extract(raw, f"^{_HEAD}", 0)
    name = F.initcap("main")
    shown = (F.when(F.col("kind") == "email", F.when(upper, F.upper(main)).otherwise(main)).when(F.col("kind") == "ip", main)
             .when(F.col("kind") == "iban", spaced)
             .when(F.col("kind") == "person", F.concat(head, F.when(upper, F.upper(name)).otherwise(name))).otherwise(filled))
    return joined.select("raw", shown.alias("surrogate"))


def _names(hits: DataFrame, parts: DataFrame, drawn: DataFrame) -> DataFrame:
    """(pii_id, pii_hash, pii_names): for each document with names, the surrogate of each word of them."""
    words = parts.where("kind = 'person'").join(drawn, ["entity", "norm"]).where(F.length("norm") > 1).select("raw", "entity", "norm", "surrogate")
    # A word that is both is the family's.
    each = hits.where("kind = 'person'").join(words, "raw").groupBy("pii_id", "pii_hash", "norm").agg(
        F.max_by("surrogate", F.struct(F.col("entity").startswith("family"), "surrogate")).alias("surrogate"))
    return each.groupBy("pii_id", "pii_hash").agg(F.map_from_entries(F.collect_list(F.struct("norm", "surrogate"))).alias("pii_names"))


def _renamed(text: Column, names: Column) -> Column:
    """``text`` with the words of ``names`` replaced, a genitive's ending apart."""
    def word(w: Column) -> Column:
        base = F.regexp_replace(w, "['’]s$", "")
        new = F.try_element_at(names, F.lower(base))
        cased = F.when((base == F.upper(base)) & (F.length(base) > 1), F.upper(new)).otherwise(F.initcap(new))
        return F.when(w.rlike(r"^\p{Lu}") & new.isNotNull(), F.concat(cased, F.substr(w, F.length(base) + 1))).otherwise(w)

    return F.array_join(F.transform(F.split(text, _EDGE), word), "")


def pseudonymise(df: DataFrame, key: str = DEFAULT_KEY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` with surrogates in place of entities, and ``n_<kind>`` long of each kind of entity."""
    names = [f"n_{k}" for k in KINDS]
    rows = df.select(*kept(df, *names, "pii_id", "pii_hash", "pii_found", "pii_names"))
    text = col(text_column)
    keyed = rows.where(_maybe(text)).withColumns({"pii_id": col(id_column), "pii_hash": F.xxhash64(text)})
    hits = keyed.select("pii_id", "pii_hash", F.posexplode(_found(text)).alias("place", "raw")).distinct()
    hits = _table(hits.withColumn("kind", _kind_column(F.col("raw"))), "pii-hits")
    parts = _table(_entities(hits.where("kind <> 'none'").select("raw", "kind").distinct()), "pii-parts")
    drawn = surrogates(parts.select("entity", "norm").distinct(), key)
    placed = hits.join(_rendered(parts, drawn), "raw", "left").withColumn("surrogate", F.coalesce("surrogate", "raw")).groupBy("pii_id", "pii_hash").agg(
        F.array_sort(F.collect_list(F.struct("place", "surrogate", "kind"))).alias("pii_found"))
    key_of = lambda t: F.col("d.pii_id").eqNullSafe(F.col(f"{t}.pii_id")) & (F.col("d.pii_hash") == F.col(f"{t}.pii_hash"))
    named = placed.alias("d").join(_names(hits, parts, drawn).alias("w"), key_of("w"), "left")
    placed = named.select("d.*", "pii_names")
    # Only texts that may hold an entity are shuffled.
    same = key_of("p")
    met = keyed.alias("d").join(placed.alias("p"), same, "left")
    between = F.split(text, DETECT, -1)
    between = F.when(F.col("pii_names").isNull(), between).otherwise(F.transform(between, lambda t: _renamed(t, F.col("pii_names"))))
    new = F.array_join(F.zip_with(between, F.concat("p.pii_found.surrogate", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    new = F.when(F.col("p.pii_found").isNull(), text).otherwise(new)
    of_kind = lambda kind: F.coalesce(F.size(F.filter("p.pii_found", lambda x: x["kind"] == kind)), F.lit(0))
    n = [F.when(F.col("p.pii_found").isNull(), 0).otherwise(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    changed = met.select(*[new.alias(c) if c == text_column else F.col("d." + quoted(c)) for c in rows.columns], *n)
    clean = rows.where(~_maybe(text)).select(*[col(c) for c in rows.columns], *[F.lit(0).cast("long").alias(c) for c in names])
    return clean.unionByName(changed)
