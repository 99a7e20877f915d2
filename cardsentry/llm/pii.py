"""Personal data replaced by keyed surrogates (operator 1), DataFrame
functions only.

Detected: e-mail addresses, phone numbers with a country code or in the North
American national shapes (``(555) 201-7788``, ``555-201-7788``), payment card
numbers, IPv4 addresses, US social security numbers, secrets that follow a
name such as ``token =``, ``API_KEY=`` or ``"client_secret":`` (16 characters,
or six with a digit or in quotes), and names after a title (Dr and Prof tell no gender, so their surrogates have a neutral form).  A national number
is that of country code 1.  An entity is a type and a
canonical value (digits only, lower case), so the same number written in two
ways is one entity and keeps one surrogate everywhere (coreference).

A surrogate is drawn from SHA-256 over the key, type, value and a round
number.  It keeps type and format: digits fill the shape in which the original
stood, the country code and a card's first digit stay, a card that passes the
Luhn check gets one that does, an e-mail keeps the shape of its local part and
goes to the reserved ``.example`` domain, a secret keeps its characters'
classes, a name keeps its title, case, script and the gender of the title.

Collision checks run on the table of distinct entities: of entities of a type
that draw one surrogate the first by value keeps it, and a surrogate that is
itself a value in the corpus is refused; the others draw again in the next
round.  So surrogates are distinct, and rounds end.

Only documents with a finding are rebuilt; a document's findings are its own
row group, an entity however frequent is one row, and the join from occurrences
to surrogates is an ordinary equi-join that AQE may split.

A bare number of 13 to 19 digits is a card only if it begins like one (2 to 6)
and passes the Luhn check; four groups of four are one in any case.

Defined cases: null and empty texts stay as they are; very long texts, of
whatever characters, are matched without recursion; repeated rows get equal
texts; rows without an id are handled like any other; of entities that draw one
surrogate the smallest value keeps it; an empty table gives no rows; a type
whose surrogates are used up raises an error; other columns stay, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import materialize

# Titles by gender and script.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "г-н"]
NEUTRAL = ["Dr", "Prof", "Mx"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "г-жа"]
SECRET_NAMES = ["token", "api_key", "apikey", "api-key", "secret", "password", "passwd", "access_key", "secret_key", "private_key",
                "pwd", "passphrase"]
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ha", "jo", "ka", "ke", "la", "le", "li", "lo", "ma",
              "me", "mi", "mo", "na", "ne", "ni", "no", "pa", "ra", "re", "ri", "ro", "sa", "se", "si", "ta", "te", "ti", "to", "va", "vi"],
    "cyrillic": ["ба", "бо", "ва", "ве", "да", "де", "до", "за", "ка", "ко", "ла", "ле", "ли", "ло", "ма", "ме", "ми", "мо", "на", "не",
                 "ни", "но", "па", "ра", "ре", "ри", "ро", "са", "се", "си", "та", "те", "ти", "то"],
}
ENDINGS = {"given_n": {"latin": "s", "cyrillic": "с"}, "given_f": {"latin": "na", "cyrillic": "на"}, "given_m": {"latin": "r", "cyrillic": "р"},
           "family": {"latin": "lin", "cyrillic": "лин"}}

# Possessive, and only from the start of a word: a word without an @ is read once.
# The domain is one run of characters, of which DNS allows 253: a group per label would recurse in the JVM.
_DOMAIN = r"(?![.-])[A-Za-z0-9.-]{1,250}\.[A-Za-z]{2,63}"
_EMAIL = rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]++@{_DOMAIN}"
_PHONE = r"(?<![\p{L}\d+])\+\d{1,3}(?:[ .-]?\(\d{2,4}\))?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
_NATIONAL = r"(?<![\p{L}\d+(.-])(?:(?:1[ .-])?\(\d{3}\) ?\d{3}[ .-]\d{4}|(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4})(?![\d]|[.-]\d)"
_CARD = r"(?<![\d.-])(?:\d{4}[ -]){3}\d{4}(?!\d)|(?<![\d.-])\d{13,19}(?!\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"(?<![\d.]|[Vv]|[Vv]ersion )(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d)"
# After the name, perhaps with a prefix and a closing quote; four letters or digits at least, of which a surrogate is made.
_SECRET = (
    r"(?<=[:=]\s{0,3}[\"']{0,1})(?=(?:[^\s\"'<>]{0,40}?[A-Za-z0-9]){4})"
    rf"(?<=(?i:{'|'.join(SECRET_NAMES)})[\"']{{0,1}}\s{{0,3}}[:=]\s{{0,3}}[\"']{{0,1}})"
    r"(?:(?<=[\"'])[^\s\"'<>]{6,}(?=[\"'])"
    r"|(?=[A-Za-z+/_=.!@#$%^*~-]{0,15}\d)[A-Za-z0-9+/_=.!@#$%^*~-]{5,}[A-Za-z0-9+/_=!@#$%^*~-]"
    r"|[A-Za-z0-9+/_=-]{16,})"
)
_TITLE = rf"(?:{'|'.join([*MALE, *FEMALE, *NEUTRAL])})\.? "
_NAME = rf"(?<![\p{{L}}]){_TITLE}\p{{Lu}}[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+)?"
PATTERN = "|".join([_EMAIL, _SECRET, _PHONE, _NATIONAL, _IP, _SSN, _CARD, _NAME])

# Type of a match that is no personal data after all: a long number that is no card's.
PLAIN = "plain"
# Draws per entity before a type counts as used up.
MAX_ROUNDS = 64


def may_hold(text: Column) -> Column:
    """Whether a text has a digit, an @, a secret's name or a title: what every
    finding has, at a fraction of the pattern's cost."""
    may = text.contains("@") | text.rlike("[0-9]")
    for word in SECRET_NAMES:
        may = may | F.lower(text).contains(word)
    for word in [*MALE, *FEMALE, *NEUTRAL]:
        may = may | text.contains(word)
    return may


def _is(pattern: str, c: Column) -> Column:
    return c.rlike(f"^(?:{pattern})$")


def parts_of(match: Column) -> Column:
    """The entities in one match: type, canonical value, text as found.

    A name after a title has one entity a word, so that ``Mr Ames`` and
    ``Mr Tom Ames`` share a family name."""
    words = F.split(F.regexp_replace(match, "^" + _TITLE, ""), " ")
    gender = (
        F.when(match.rlike("^(?:" + "|".join(FEMALE) + r")\b"), F.lit("given_f"))
        .when(match.rlike("^(?:" + "|".join(NEUTRAL) + r")\b"), F.lit("given_n")).otherwise(F.lit("given_m")))
    name = F.transform(words, lambda w, i: F.struct(
        F.when(i == F.size(words) - 1, F.lit("family")).otherwise(gender).alias("type"), F.lower(w).alias("value"), w.alias("found")))

    def one(kind: str, value: Column) -> Column:
        return F.array(F.struct(F.lit(kind).alias("type"), value.alias("value"), match.alias("found")))

    digits = F.regexp_replace(match, r"\D", "")
    return (
        F.when(match.contains("@") & match.rlike(rf"^[\p{{L}}\p{{N}}._%+-]++@{_DOMAIN}$"), one("email", F.lower(match)))
        .when(match.rlike("^" + _TITLE), name)
        .when(match.rlike(r"^\+[\d .()-]+$"), one("phone", digits))
        .when(_is(_NATIONAL, match), one("phone", F.concat(F.when(F.length(digits) == 10, "1").otherwise(""), digits)))
        .when(_is(_IP, match), one("ip", match))
        .when(_is(r"\d{3}-\d{2}-\d{4}", match), one("ssn", digits))
        .when(match.rlike(r"^\d{4}[ -]\d") & match.rlike(r"^[\d -]+$"), one("card", digits))
        .when(match.rlike(r"^\d{13,19}$"), F.when(match.rlike("^[2-6]") & (_luhn_sum(match) % 10 == 0), one("card", match)).otherwise(one(PLAIN, match)))
        .otherwise(one("secret", match))
    )


def _seed(key: str, kind: Column, value: Column, rnd: Column) -> Column:
    """60 bits of SHA-256 over key, type, value and round."""
    text = F.concat_ws("\x1f", F.lit(key), kind, value, rnd.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _draw(seed: Column, i: Column | int, n: int) -> Column:
    i = F.lit(i) if isinstance(i, int) else i
    return F.pmod(F.xxhash64(seed, i.cast("int")), F.lit(n)).cast("int")


def _letter(i: Column, first: str) -> Column:
    return F.char(F.lit(ord(first)) + i)


def _reshaped(value: Column, seed: Column) -> Column:
    """Digits for digits, letters for letters of the same case, the rest as it
    is; cut into characters once, so the time follows the length."""
    def one(c: Column, i: Column) -> Column:
        return (
            F.when(c.rlike(r"\d"), _draw(seed, i, 10).cast("string"))
            .when(c.rlike(r"\p{Lu}"), _letter(_draw(seed, i, 26), "A"))
            .when(c.rlike(r"\p{L}"), _letter(_draw(seed, i, 26), "a")).otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _digits(value: Column, seed: Column, keep: Column, least: int) -> Column:
    """As many digits as ``value``, the first ``keep`` of them kept, the next
    one at least ``least``."""
    def one(i: Column) -> Column:
        drawn = _draw(seed, i, 10)
        return (
            F.when(i <= keep, F.substring(value, i, F.lit(1)))
            .when(i == keep + 1, (F.lit(least) + F.pmod(drawn + _draw(seed, i + 100, 10), F.lit(10 - least))).cast("string"))
            .otherwise(drawn.cast("string"))
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number whose check digit stands last."""
    n = F.length(digits)

    def one(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), one), F.lit(0), lambda a, x: a + x)


def _card(value: Column, seed: Column) -> Column:
    drawn = _digits(value, seed, F.lit(1), 0)
    body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    check = F.pmod(F.lit(10) - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    return F.when(_luhn_sum(value) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(drawn)


def _syllables(kind: Column, value: Column, seed: Column, rnd: Column) -> Column:
    def script(which: str) -> Column:
        some = SYLLABLES[which]
        stem = F.array_join(F.transform(
            F.sequence(F.lit(1), F.lit(2) + F.floor(rnd / 2).cast("int")),
            lambda i: F.element_at(F.array(*map(F.lit, some)), _draw(seed, i, len(some)) + 1)), "")
        end = F.coalesce(*[F.when(kind == k, F.lit(v[which])) for k, v in ENDINGS.items()])
        return F.concat(stem, end)

    return F.when(value.rlike(r"\p{IsCyrillic}"), script("cyrillic")).otherwise(script("latin"))


def _email(value: Column, seed: Column, rnd: Column) -> Column:
    local = _reshaped(F.regexp_extract(value, "^(.*)@", 1), seed)
    more = F.when(rnd > 2, _draw(seed, 777, 1_000_000).cast("string")).otherwise(F.lit(""))
    domain = F.array_join(F.array(*[_letter(_draw(seed, 500 + i, 26), "a") for i in range(6)]), "")
    return F.concat(local, more, F.lit("@"), domain, F.lit(".example"))


def surrogate(key: str, kind: Column, value: Column, rnd: Column) -> Column:
    """The canonical surrogate of an entity in a round."""
    seed = _seed(key, kind, value, rnd)
    octets = [F.lit(1) + _draw(seed, 0, 223), _draw(seed, 1, 256), _draw(seed, 2, 256), F.lit(1) + _draw(seed, 3, 254)]
    # The country code: 1 and 7 have one digit, the others are taken as two.
    code = F.when(value.rlike("^[17]"), F.lit(1)).otherwise(F.lit(2))
    return (
        F.when(kind == "email", _email(value, seed, rnd))
        .when(kind == "phone", _digits(value, seed, code, 2))
        .when(kind == "card", _card(value, seed))
        .when(kind == "ssn", _digits(value, seed, F.lit(0), 1))
        .when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
        .when(kind == "secret", F.when(value.rlike("^[0-9a-f]+$"), _hex(value, seed)).otherwise(_reshaped(value, seed)))
        .otherwise(_syllables(kind, value, seed, rnd))
    )


def _hex(value: Column, seed: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.lower(F.hex(_draw(seed, i, 16).cast("long")))), "")


def rendered(kind: Column, found: Column, value: Column) -> Column:
    """A canonical surrogate in the form in which the original stood, without
    the country code if that had none."""
    unsaid = F.length(value) - F.length(F.regexp_replace(found, r"\D", ""))

    def one(i: Column) -> Column:
        c = F.substring(found, i, F.lit(1))
        nth = F.length(F.regexp_replace(F.substring(found, F.lit(1), i), r"\D", ""))
        return F.when(c.rlike(r"\d"), F.substring(value, nth + unsaid, F.lit(1))).otherwise(c)

    shaped = F.array_join(F.transform(F.sequence(F.lit(1), F.length(found)), one), "")
    name = F.when((F.length(found) > 1) & (F.upper(found) == found), F.upper(value)).otherwise(F.initcap(value))
    return F.when(kind.isin("phone", "card", "ssn"), shaped).when(kind.isin("family", "given_m", "given_f", "given_n"), name).otherwise(value)


def resolve(entities: DataFrame, key: str) -> DataFrame:
    """type, value, surrogate of distinct entities (type, value): rounds of
    drawing and checking until every entity has a surrogate of its own."""
    # A small file would be one task, and drawing is the work here.
    spread = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entities = materialize(entities, "pii-entities")
    taken = entities.select("type", F.col("value").alias("surrogate"))
    pending, done = entities, None
    for rnd in range(MAX_ROUNDS):
        drawn = materialize(
            pending.repartition(spread, "type", "value").withColumn("surrogate", surrogate(key, F.col("type"), F.col("value"), F.lit(rnd)))
            .join(taken, ["type", "surrogate"], "left_anti"), "pii-drawn")
        first = drawn.groupBy("type", "surrogate").agg(F.min("value").alias("value"))
        kept = materialize(first.select("type", "value", "surrogate"), "pii-kept")
        done = kept if done is None else done.unionByName(kept)
        pending = materialize(pending.join(kept.select("type", "value"), ["type", "value"], "left_anti"), "pii-pending")
        if pending.isEmpty():
            return done
        taken = taken.unionByName(kept.select("type", "surrogate"))
    raise ValueError("a type has more entities than surrogates")


def replace(docs: DataFrame, key: str, *, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced, all other columns as
    they are; ``count`` names an added column with the number of findings."""
    t = F.col(f"`{text}`")
    holds = F.coalesce(may_hold(t.cast("string")) & t.cast("string").rlike(PATTERN), F.lit(False))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), holds.alias("_holds"))
    dirty = materialize(whole.where("_holds").select(
        "d", F.regexp_extract_all(F.col(f"d.`{text}`").cast("string"), F.lit(PATTERN), F.lit(0)).alias("m"),
        F.monotonically_increasing_id().alias("r")), "pii-documents")
    parts = dirty.select("r", F.posexplode("m").alias("at", "match")).select(
        "r", "at", F.regexp_extract("match", "^" + _TITLE, 0).alias("title"), F.posexplode(parts_of(F.col("match"))).alias("nth", "p"))
    parts = parts.select("r", "at", "nth", "title", "p.type", "p.value", "p.found")
    surrogates = materialize(resolve(parts.where(F.col("type") != PLAIN).select("type", "value").distinct(), key), "pii-surrogates")
    kept = F.col("type") == PLAIN
    said = parts.join(surrogates, ["type", "value"], "left").withColumn(
        "said", F.when(kept, F.col("found")).otherwise(rendered(F.col("type"), F.col("found"), F.col("surrogate"))))
    # The findings of one document, in order; words of one name with a space between.
    ordered = F.array_sort(F.collect_list(F.struct("at", "nth", "title", "said")))
    lists = said.groupBy("r").agg(ordered.alias("s"), F.sum(((F.col("nth") == 0) & ~kept).cast("int")).cast("int").alias("n"))
    glued = F.transform(F.col("s"), lambda x: F.concat(
        F.when(x["nth"] == 0, F.concat(F.lit("\x00"), x["title"])).otherwise(F.lit(" ")), x["said"]))
    # The first element, before the first border, is empty.
    replacements = F.split(F.array_join(glued, ""), "\x00")
    rebuilt = dirty.join(lists, "r").select("d", "n", replacements.alias("s"))
    literals = F.split(F.col(f"d.`{text}`").cast("string"), PATTERN, -1)
    # Both lists are made once a row: a lambda that names one would make it again for each element.
    new_text = F.array_join(F.zip_with(literals, F.col("s"), lambda x, said: F.concat(F.coalesce(said, F.lit("")), x)), "")

    def columns(changed: bool) -> list[Column]:
        out = [(new_text if changed and c == text else F.col(f"d.`{c}`")).alias(c) for c in docs.columns]
        return out if count is None else [*out, (F.col("n") if changed else F.lit(0)).alias(count)]

    return whole.where("not _holds").select(*columns(False)).unionByName(rebuilt.select(*columns(True)))
