"""PII surrogates: detected entities are replaced by keyed stand-ins of the same type.

Detection is one pattern over the text. Every distinct entity of the corpus gets
one surrogate, made from a keyed digest of its type and canonical form, so the
same entity reads the same everywhere, however it is written: a phone number
keeps its punctuation and a name its title. Phones are told by their last ten
digits, with or without what dials a country. Names are found after titles; a
second pass replaces them wherever else their own text has them. Surrogates fit their type: card
numbers pass the Luhn check, addresses are valid, given names follow the script
of the name and the gender that most of its titles tell, so that a person stays
one under any title. A surrogate that two entities share, or that is an entity of
the corpus itself, is made again from the next attempt until all are distinct;
given and family names are one space. Attempts make room: names gain a syllable each, and what
is short, like mailboxes, secrets and phones, gains digits (``GROWS``), so there
are surrogates for any number of entities.

Everything is column expressions. Texts without a character that any entity
needs are passed through; the others meet their replacements by id and text.

Defined results: NULL and empty texts stay as they are; repeated rows get equal
results; NULL ids are kept; digits that look like a card number but fail its
check are left alone, and so are masked secrets, one sign again and again
('password=****'); one string is one type, in the order of ``KINDS``. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subpulse.llm.common import lookup
from subpulse.session import settle

# fixed values: titles by gender, and given names by script and gender
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Herrn", "Señor", "Monsieur", "господин", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mademoiselle", "госпожа", "г-жа"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    ("Latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Julian", "Leon", "Marco", "Oscar"],
    ("Latin", "f"): ["Alma", "Bianca", "Clara", "Diana", "Elena", "Flora", "Greta", "Ines", "Julia", "Lena", "Maria", "Nora"],
    ("Latin", "n"): ["Alex", "Andrea", "Ariel", "Charlie", "Dana", "Kim", "Luca", "Noa", "Robin", "Sasha", "Toni", "Yael"],
    ("Cyrillic", "m"): ["Антон", "Борис", "Виктор", "Денис", "Егор", "Иван", "Максим", "Павел", "Роман", "Сергей"],
    ("Cyrillic", "f"): ["Алина", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья", "Юлия"],
    ("Cyrillic", "n"): ["Женя", "Саша", "Валя", "Слава", "Тоня", "Паша", "Лёня", "Митя"],
}
SYLLABLES = {
    "Latin": "ba ben da del fa gor ha jen ka lin ma mor na nel or pa ren sa sel ta tor va ver wa win zan".split(),
    "Cyrillic": "ба бел ва гор да дан жи за кал ла лев ма мир на нов ор па ров са сол та тур фе хо".split(),
}
#: The alphabets whose letters and digits a shape is refilled with.
ALPHABETS = {r"\d": "0123456789", r"[a-z]": "abcdefghijklmnopqrstuvwxyz", r"[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя", r"\p{L}": "abcdefghijklmnopqrstuvwxyz", r"\p{N}": "0123456789"}
CYRILLIC = r"\p{IsCyrillic}"

_TITLE = "(?:" + "|".join(t for titles in TITLES.values() for t in sorted(titles, key=len, reverse=True)) + r")\.?"
#: A capitalised word, without the s of the genitive.
_NAME = r"\p{Lu}(?:\p{L}|['’](?!s(?!\p{L}))(?=\p{L})|-(?=\p{L}))++"
#: North American groups; French pairs; other numbers from a trunk 0 or 00 on. Dates have fewer digits.
_PLAIN_PHONE = (r"(?=\d)(?<![\w.,/-])(?:(?:1[-. ])?\d{3}[-.]\d{3}[-.]\d{4}|(?:1 )?[2-9]\d\d \d{3}[- ]\d{4}"
                r"|0[1-9](?:[ .-]\d\d){4}|0[1-9]\d{1,4}[-/ ]\d{5,8}|0\d{1,4}[- ]\d{3,4}[- ]\d{3,4}"
                r"|0[1-9]\d{2,3}(?:[ -]\d{2,4}){3}|00[1-9]\d{0,2}(?:[ .-]\d{2,4}){2,5})(?![\w/-]|[.,]\d)")
#: Seven digits or more after a word for phones, however they are grouped.
_LABELLED_PHONE = (r"(?=[tpmcfTPMCF])(?<!\w)(?i:tel(?:ephone)?|phone|mobile|cell|fax)(?i: no\.?| number)?[.:]?[ \t]{0,3}"
                   r"(?=\(?\d(?:[ ./()-]{0,2}\d){6})\(?\d{2,5}\)?(?:[ ./-]{0,2}\d{2,5}){1,5}(?!\w)")
#: A hex digest or key, which is of its own kind also where it stands behind a label and a space or quote.
_DIGEST = r"(?:[0-9a-f]{32,64}|AKIA[0-9A-Z]{16})(?!\w)"
#: In order: what matches first at a place is taken. Secrets keep the label before them.
KINDS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    # prose goes on after 'secret: ', so an unquoted value has a digit there
    "secret": r"(?=[pstaPSTA])(?<!\w)(?:(?i:password|passwd|pwd|api[_ -]?key)[\"']?[ \t]{0,3}[=:][ \t]{0,3}|(?i:secret|token)[\"']?"
              r"(?:[=:](?=\S)|[ \t]{0,3}[=:][ \t]{0,3}(?=[\"']|[^\s\"',;]*\d)))"
              rf"(?![\"']{_DIGEST}|(?<!\w[=:]){_DIGEST})"
              r"(?:\"[^\"\r\n]{4,128}\"|'[^'\r\n]{4,128}'|[\"']?[^\s\"',;]{4,})",
    "key": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)",
    "hex": r"(?<!\w)[0-9a-f]{32,64}(?!\w)",
    "card": r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?|\(\d{2,4}\)[ .-]?)\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)"
             rf"|{_PLAIN_PHONE}|{_LABELLED_PHONE}",
    "person": rf"(?<!\w){_TITLE}(?: {_NAME}){{1,3}}",
}
SECRET_HEAD, SECRET_VALUE = r"^[^=:]+[=:][ \t]*[\"']?", r"^[^=:]+[=:][ \t]*[\"']?(.*?)[\"']?$"
WORD_OR_NAME = rf"(?<![\p{{L}}\p{{N}}_]){_NAME}"
PATTERN = "|".join(KINDS.values())
#: A text without any of these holds no entity.
NEEDED = rf"[@=:\d]|[0-9a-f]{{32}}|AKIA[0-9A-Z]{{16}}|{_TITLE} \p{{Lu}}"
#: From this attempt on a surrogate is longer than its entity, by so many digits an attempt.
GROWS = {"email": (1, 2), "secret": (1, 2), "phone": (4, 1), "ssn": (20, 1)}
#: From this attempt on an IP address is one of version 6, as there are only so many of version 4.
SIXTH_FROM = 20


def _digits(c: str | Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _phone_end(digits: Column) -> Column:
    """What tells a phone: its last ten digits, without zeros that lead."""
    return F.right(F.regexp_replace(digits, "^0+(?=[1-9])", ""), F.lit(10))


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _number(seed: Column, at: Column | int) -> Column:
    """A number from four hex digits of the seed; ``at`` counts from 0 and wraps around."""
    return F.conv(F.substring(seed, (F.lit(at) * 2 % 124 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def _pick(values: list[str], seed: Column, at: Column | int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), _number(seed, at) % len(values) + 1)


def _shape(c: Column, seed: Column) -> Column:
    """Each letter or digit becomes one of its own kind, everything else stays."""
    def one(char: Column, i: Column) -> Column:
        new = F.lit(None).cast("string")
        for pattern, letters in reversed(ALPHABETS.items()):
            new = F.when(char.rlike(pattern), F.substring(F.lit(letters), _number(seed, i) % len(letters) + 1, F.lit(1))
                         ).otherwise(new)
        return F.coalesce(new, char)

    return F.array_join(F.transform(_chars(c), one), "")


def _luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """The Luhn sum from the right; ``doubled_first``: the rightmost digit is doubled."""
    def value(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = n * 2 - F.when(n > 4, 9).otherwise(0)
        return F.when(i % 2 == (0 if doubled_first else 1), twice).otherwise(n)

    return F.aggregate(F.transform(F.reverse(_chars(digits)), value), F.lit(0), lambda x, y: x + y)


def _refill(written: str, digits: str) -> Column:
    """``written`` with its digits replaced, one by one, by those of ``digits``; what is left of these ends it."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(done: Column, char: Column) -> Column:
        digit = char.rlike(r"\d")
        new = F.when(digit, F.substring(F.col(digits), done["k"] + 1, F.lit(1))).otherwise(char)
        return F.struct(F.concat(done["out"], new).alias("out"),
                        F.when(digit, done["k"] + 1).otherwise(done["k"]).alias("k"))

    return F.aggregate(_chars(F.col(written)), start, step,
                       lambda x: F.concat(x["out"], F.substring(F.col(digits), x["k"] + 1, F.length(digits))))


def mentions(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, mentions): what matches in each distinct (id, text), in order; only texts with a match."""
    found = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    return (documents.filter(F.col("text").rlike(NEEDED)).select("doc_id", "text_key", found.alias("mentions"))
            .filter(F.size("mentions") > 0).distinct())


def classified(found: DataFrame) -> DataFrame:
    """Each distinct mention with its kind (NULL: leave it alone) and its entities, an array of (kind, canon, gender).

    The gender is that of a person's title; a given name is one entity whatever titles stand before it.
    """
    kind = F.coalesce(*(F.when(F.col("mention").rlike(f"^(?:{pattern})$"), F.lit(name))
                        for name, pattern in KINDS.items()))
    title = F.regexp_extract("mention", f"^({_TITLE}) ", 1)
    bare = F.regexp_replace(title, r"\.$", "")
    gender = F.coalesce(*(F.when(bare.isin(titles), F.lit(g)) for g, titles in TITLES.items()))
    names = F.split(F.expr("substring(mention, length(title) + 2)"), " ")
    tokens = F.transform("names", lambda n, i: F.struct(
        F.when(i == F.size("names") - 1, F.lit("family")).otherwise(F.lit("given")).alias("kind"), n.alias("canon"),
        F.col("gender").alias("gender")))
    canon = (F.when(F.col("kind") == "email", F.lower("mention"))
             .when(F.col("kind") == "secret", F.regexp_extract("mention", SECRET_VALUE, 1))
             .when(F.col("kind") == "phone", _phone_end(_digits("mention")))
             .when(F.col("kind").isin("card", "ssn"), _digits("mention")).otherwise(F.col("mention")))
    counted = found.select(F.explode("mentions").alias("mention")).groupBy("mention").agg(
        F.count(F.lit(1)).alias("n"))
    kinds = counted.withColumn("kind", kind)
    masked = F.regexp_extract("mention", SECRET_VALUE, 1).rlike(r"^([^\p{L}\p{N}])\1*$")
    kinds = kinds.withColumn("kind", F.when((F.col("kind") == "card") & (_luhn_sum(_digits("mention"), False) % 10 != 0),
                                            F.lit(None)).when((F.col("kind") == "secret") & masked, F.lit(None)).otherwise(
                                                F.col("kind")))
    return (kinds.withColumns({"title": title, "gender": gender}).withColumn("names", names)
            .withColumn("entities", F.when(F.col("kind") == "person", tokens).otherwise(
                F.array(F.struct(F.col("kind").alias("kind"), canon.alias("canon"), F.lit(None).cast("string").alias("gender")))))
            .select("mention", "n", "kind", "title", "entities"))


def _made(key: str) -> Column:
    """The surrogate of (kind, canon) at an attempt."""
    canon, attempt = F.col("canon"), F.col("attempt")
    seed = F.sha2(F.concat_ws("\n", F.lit(key), "kind", attempt.cast("string"), "canon"), 512)
    domain = F.substring_index(canon, "@", -1)
    domain_seed = F.sha2(F.concat_ws("\n", F.lit(key), F.lit("domain"), domain), 512)
    top = F.substring_index(domain, ".", -1)
    grown = F.lit(0)
    for kind, (first, digits) in GROWS.items():
        grown = F.when(F.col("kind") == kind, F.greatest(attempt - first + 1, F.lit(0)) * digits).otherwise(grown)
    tail = F.when(grown > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(grown, F.lit(1))), lambda i: (
        _number(seed, 61 - i) % 10).cast("string")), "")).otherwise(F.lit(""))
    email = F.concat(_shape(F.substring_index(canon, "@", 1), seed), tail, F.lit("@"),
                     _shape(F.expr("substring(canon, instr(canon, '@') + 1, length(canon) - instr(canon, '@') - "
                                   "length(substring_index(canon, '.', -1)))"), domain_seed), top)
    octets = F.concat_ws(".", *((_number(seed, i) % 254 + 1).cast("string") for i in range(4)))
    sixth = F.concat(F.lit("fd00:"), F.array_join(F.array(*(F.substring(seed, 1 + 4 * i, 4) for i in range(7))), ":"))
    phone = F.concat((_number(seed, 60) % 8 + 2).cast("string"), _shape(F.expr("substring(canon, 2)"), seed))
    body = F.concat(F.substring(canon, 1, 1), _shape(F.expr("substring(canon, 2, length(canon) - 2)"), seed))
    card = F.concat(body, ((10 - _luhn_sum(body, True) % 10) % 10).cast("string"))
    hexed = F.substring(F.repeat(seed, 8), F.lit(1), F.length(canon))
    # signs alone have nothing to be refilled with
    secret = F.when(canon.rlike("^[0-9a-f]{1,1024}$") | ~canon.rlike(r"[\p{L}\p{N}]"), hexed).otherwise(_shape(canon, seed))

    def name(script: str) -> Column:
        places = F.sequence(F.lit(0), F.least(attempt, F.lit(12)) + 2)
        syllables = F.initcap(F.array_join(F.transform(places, lambda i: _pick(SYLLABLES[script], seed, i * 4 + 8)), ""))
        made = F.when(F.col("kind") == "family", syllables)
        for gender in TITLES:
            first, second = (_pick(GIVEN[script, gender], seed, i) for i in (0, 4))
            more = F.when(attempt == 0, F.lit("")).when(attempt < 4, F.concat(F.lit("-"), second)).otherwise(
                F.concat(F.lit("-"), second, F.lit("-"), syllables))
            made = made.when((F.col("kind") == "given") & (F.col("gender") == gender), F.concat(first, more))
        return made

    return (F.when(F.col("kind") == "email", email)
            .when(F.col("kind") == "ip", F.when(attempt < SIXTH_FROM, octets).otherwise(sixth))
            .when(F.col("kind") == "phone", F.concat(phone, tail))
            .when(F.col("kind") == "card", card)
            .when(F.col("kind") == "ssn", F.concat(_shape(canon, seed), tail)).when(F.col("kind") == "hex", hexed)
            .when(F.col("kind") == "secret", F.concat(secret, tail))
            .when(F.col("kind") == "key", F.concat(F.lit("AKIA"), _shape(F.expr("substring(canon, 5)"), seed)))
            .when(canon.rlike(CYRILLIC), name("Cyrillic")).otherwise(name("Latin")))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon[, gender]): no two alike, and none that the corpus itself has.

    Given and family names are one space: a made name of either kind is no real name of the other. The spaces grow
    with the attempts, so this ends.
    """
    if "gender" not in entities.columns:
        entities = entities.withColumn("gender", F.lit(None).cast("string"))
    entities = entities.withColumn("space", F.when(F.col("kind").isin("given", "family"), "name").otherwise(F.col("kind")))
    made = settle(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", _made(key)), "surrogates")
    while True:
        # of those that share a surrogate, the first by canonical form may keep it
        rank = F.row_number().over(Window.partitionBy("space", "surrogate").orderBy("attempt", "canon", "kind"))
        real = made.select("space", F.col("canon").alias("surrogate"), F.lit(True).alias("real")).distinct()
        rated = settle(made.withColumn("rank", rank).join(real, ["space", "surrogate"], "left").select(
            "space", "kind", "canon", "gender", "attempt", "surrogate",
            ((F.col("rank") > 1) | F.coalesce("real", F.lit(False))).alias("again")), "surrogates")
        if rated.filter("again").isEmpty():
            return rated.select("kind", "canon", "surrogate")
        made = settle(rated.withColumn("attempt", F.col("attempt") + F.col("again").cast("int")).withColumn(
            "surrogate", F.when(F.col("again"), _made(key)).otherwise(F.col("surrogate"))).drop("again"), "surrogates")


def replacements(found: DataFrame, key: str) -> DataFrame:
    """(mention, n, kind, replacement) of every distinct mention."""
    known = settle(classified(found), "mentions")
    parts = known.filter("kind IS NOT NULL").select("mention", "n", F.posexplode("entities").alias("at", "entity")).select(
        "mention", "at", "n", "entity.kind", "entity.canon", "entity.gender")
    # a name's gender is that of most of its titles that tell one, so that one person stays one under any title
    per_gender = parts.groupBy("kind", "canon", "gender").agg(F.sum("n").alias("n"))
    telling = F.struct((F.col("gender") != "n").alias("tells"), "n", "gender")
    one = per_gender.groupBy("kind", "canon").agg(F.max(telling).alias("most")).select("kind", "canon", "most.gender")
    made = surrogates(one, key)
    # an entity has few spellings, so these joins have no hot keys
    joined = parts.join(made, ["kind", "canon"]).groupBy("mention").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "surrogate"))),
                                 lambda x: x["surrogate"]), " ").alias("surrogate"))
    digits = _digits("mention")
    country = F.substring(digits, F.lit(1), F.length(digits) - F.length(_phone_end(digits)))
    joined = known.join(joined, "mention", "left").withColumn(
        "surrogate", F.when(F.col("kind") == "phone", F.concat(country, "surrogate")).otherwise(F.col("surrogate")))
    written = (F.when(F.col("kind").isin("card", "ssn", "phone"), _refill("mention", "surrogate"))
               .when(F.col("kind") == "secret", F.concat(F.regexp_extract("mention", SECRET_HEAD, 0), "surrogate",
                                                         F.regexp_extract("mention", "[\"']?$", 0)))
               .when(F.col("kind") == "person", F.concat_ws(" ", "title", "surrogate"))
               .otherwise(F.col("surrogate")))
    return settle(joined.select(
        "mention", "n", "kind", F.coalesce(F.when(F.col("kind").isNotNull(), written), "mention").alias("replacement")),
        "replacements")


def _names(new: str) -> Column:
    """'name surrogate' of each name in a text's persons."""
    persons = F.filter(F.col(new), lambda x: x["kind"] == "person")
    words = [lambda x, c=c: F.slice(F.split(x[c], " "), 2, 3) for c in ("mention", "replacement")]
    return F.array_distinct(F.flatten(F.transform(persons, lambda x: F.zip_with(
        words[0](x), words[1](x), lambda a, b: F.concat(a, F.lit(" "), b)))))


def _untitled(part: Column) -> Column:
    """The pieces (out, hit) of a text between entities, with ``names`` as their ``stands``; the first one counts."""
    def stand(word: Column) -> Column:
        return F.get(F.col("stands"), (F.array_position("names", word) - 1).cast("int"))

    def piece(gap: Column, word: Column) -> Column:
        head = F.substring_index(word, "-", 1)  # Smith-led
        new = F.coalesce(stand(word), F.concat(stand(head), F.substring(word, F.length(head) + 1, F.length(word))))
        return F.struct(F.concat(gap, F.coalesce(new, word, F.lit(""))).alias("out"), new.isNotNull().alias("hit"))

    return F.when(F.size("names") > 0, F.zip_with(
        F.split(part, WORD_OR_NAME, -1), F.regexp_extract_all(part, F.lit(WORD_OR_NAME), F.lit(0)), piece)).otherwise(
            F.array(F.struct(part.alias("out"), F.lit(False).alias("hit"))))


def replace_pii(documents: DataFrame, key: str) -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_entities, kinds (sorted, joined by commas)."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                 F.xxhash64("text").alias("text_key"))
    found = settle(mentions(documents), "found")
    facts = replacements(found, key)
    rows = found.select("doc_id", "text_key", F.posexplode("mentions").alias("at", "mention"))
    total = facts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    lists = lookup(rows, facts, "mention", total, "n").groupBy("doc_id", "text_key").agg(  # one text's at most
        F.array_sort(F.collect_list(F.struct("at", "replacement", "kind", F.when(
            F.col("kind") == "person", F.col("mention")).alias("mention")))).alias("new"))
    lists = lists.withColumn("pairs", _names("new")).select(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), F.transform("new", lambda x: F.struct(
            x["replacement"].alias("replacement"), x["kind"].alias("kind"))).alias("new"),
        F.transform("pairs", lambda p: F.substring_index(p, " ", 1)).alias("names"),
        F.transform("pairs", lambda p: F.substring_index(p, " ", -1)).alias("stands"))
    may_have = F.coalesce(F.col("text").rlike(NEEDED), F.lit(False))
    joined = documents.filter(may_have).join(
        settle(lists, "lists"), F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
    between = F.split("text", PATTERN, -1)
    pieces = F.flatten(F.transform(between, lambda part, i: F.concat(_untitled(part), F.array(F.struct(
        F.coalesce(F.get(F.col("new"), i)["replacement"], F.lit("")).alias("out"), F.lit(False).alias("hit"))))))
    kinds = F.filter(F.transform("new", lambda x: x["kind"]), lambda k: k.isNotNull())
    hits = F.size(F.filter("pieces", lambda x: x["hit"]))
    changed = joined.withColumn("pieces", F.when(F.col("new").isNotNull(), pieces)).select(
        "doc_id", F.when(F.col("new").isNull(), F.col("text")).otherwise(F.array_join(F.col("pieces.out"), "")).alias("text"),
        F.coalesce(F.size(kinds) + hits, F.lit(0)).cast("long").alias("n_entities"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(kinds)), ","), F.lit("")).alias("kinds"))
    return changed.unionByName(documents.filter(~may_have).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds")))
