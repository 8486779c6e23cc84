"""PII surrogates: keyed, type-consistent replacements, in DataFrame functions only.

Entities: e-mail addresses, phone numbers, payment cards, US social security
numbers, IBANs, IPv4 and IPv6 addresses, access keys, values after ``password=``,
``token =`` and the like, and names after a title.

* Every entity has a normal form (lower-case address, digits only, ...), and
  all its mentions get renderings of one surrogate: coreference holds over the
  whole corpus. An address keeps its top-level domain, and equal domains stay
  equal; a phone number keeps its country code and layout, a card its first
  digit and a valid check digit, a hexadecimal secret stays hexadecimal.
* A name's given names and its surname are entities of their own, so "Mr John
  Smith" and "Mr Smith" stay one person. Given names follow the title's gender
  and the script (Latin, Cyrillic). A name has any number of parts; an initial is
  a given name, and particles ("van", "de") go.
* A surrogate is drawn from a keyed SHA-512 of type, normal form and attempt.
  Collision check: within a type, no two entities may have one surrogate and
  none may be a real entity of the corpus; those that fail draw again. Names
  get more syllables with each attempt, so there are always enough. The check
  is a grouping of the distinct entities, repeated until none fails.

Null texts stay null and empty ones empty; texts without entities are
unchanged. Rows equal in doc_id and text are equal in the result. An empty
table stays empty. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged

_SECRET = r"(?i:password|passwd|pwd|token|secret|api_key|apikey|access_key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?"
_MALE = r"Mr|Sir|Herr|Monsieur|Señor|Sr|г-н"
_FEMALE = r"Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|г-жа"
_TITLE = rf"(?:{_FEMALE}|{_MALE}|Dr|Prof)\.? "
_WORD = r"(?:\p{Lu}\.|\p{Lu}\p{L}*+(?:['’](?!s\b)\p{L}++)*+)"  # an initial, or a name with apostrophes
_PARTICLE = r"(?:von|van|vom|zu|zur|de|der|den|del|della|di|da|das|dos|du|la|le|ter|ten|bin|ibn|al|el|af|av)"
_HEX = "[0-9A-Fa-f]{1,4}"
# type: pattern; the first that fits the whole mention names it
TYPES = {
    "secret": _SECRET + r"[A-Za-z0-9+/_.~-]{5,}[A-Za-z0-9+/_~=-]",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "key": r"\b(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_-]{20,}+)(?![A-Za-z0-9])",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])",
    "ipv6": (
        rf"(?<![0-9A-Za-z:.])(?=[:A-Fa-f]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![0-9A-Za-z:])"
    ),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (
        r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
        r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9]|[ .-][0-9])"
        r"|\+(?=(?:[ ().-]{0,3}[0-9]){7,15}(?![0-9]))[0-9]{1,3}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})){2,14}(?![0-9])"
        r"|(?<![0-9.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])"
        r"|(?<![0-9.,-])0[0-9](?:[ .-][0-9]{2}){4}(?![0-9]|[.,-][0-9])"
        r"|(?<![0-9.,-])0[0-9]{2,4}[ /-][0-9]{5,8}(?![0-9]|[.,-][0-9])"
    ),
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "name": rf"\b{_TITLE}(?:{_PARTICLE} )*+{_WORD}(?:(?:[ -]|(?<=\.))(?:{_PARTICLE} )*+{_WORD})*+",
}
ANY = "|".join(f"(?:{p})" for p in TYPES.values())
GIVEN = {  # fixed values: replacement names
    "male_latin": "James Peter Thomas Martin Lukas Paul Henri Louis Carlos Diego Marco Erik Anton Felix Hugo Oscar",
    "female_latin": "Anna Maria Laura Julia Clara Emma Louise Camille Carmen Lucia Elena Sofia Ingrid Helen Alice Nora",
    "any_latin": "Alex Robin Kim Sascha Dominique Andrea Noel Jules Sam Charlie Toni Jordan Rene Quinn Morgan Kai",
    "male_cyrillic": "Иван Пётр Сергей Павел Олег Антон Юрий Борис",
    "female_cyrillic": "Анна Мария Ольга Елена Ирина Юлия Вера Нина",
    "any_cyrillic": "Саша Женя Валя Слава Шура Паша Тоня Глеб",
}
SYLLABLES = {  # fixed values: parts of replacement surnames
    "latin": "bar den fel gor han jor kel lin mar nor pel ras sol tam ver win zan cor dal fin",
    "cyrillic": "бар ден фел гор хан кел лин мар нор пел рас сол там вер зан кор дал фин лев род",
}
ATTEMPTS = 60


def _pick(words: str, index: Column) -> Column:
    found = words.split()
    return F.element_at(F.array(*[F.lit(w) for w in found]), (index % len(found) + 1).cast("int"))


def _stream(key: str, attempt: Column, *parts: Column) -> Column:
    """128 hexadecimal digits that only the key's owner can make."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), attempt.cast("string"), *parts, F.lit(key)), 512)


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (2 * F.pmod(i, F.lit(64)) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _char(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), (n % len(alphabet) + 1).cast("int"), F.lit(1))


def _same_classes(value: Column, stream: Column, hexadecimal: Column) -> Column:
    """Random characters of the classes of ``value``: digits, lower and upper case; others stay."""

    def one(c: Column, i: Column) -> Column:
        n = _byte(stream, i)
        lower = F.when(hexadecimal, _char("abcdef", n)).otherwise(_char("abcdefghijklmnopqrstuvwxyz", n))
        return (
            F.when(c.rlike("^[0-9]$"), _char("0123456789", n)).when(c.rlike("^[a-z]$"), lower).when(c.rlike("^[A-Z]$"), F.upper(lower)).otherwise(c)
        )

    chars = F.split(value, "")
    return F.array_join(F.transform(chars, one), "")


def _digits(norm: Column, stream: Column, keep: Column) -> Column:
    """Random digits for all but the first ``keep``; the first random one is not 0 or 1."""

    def one(c: Column, i: Column) -> Column:
        n = _byte(stream, i)
        return F.when(i < keep, c).when(i == keep, _char("23456789", n)).otherwise(_char("0123456789", n))

    return F.array_join(F.transform(F.split(norm, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of a digit string by the check rule of payment cards; 0 modulo 10 is valid."""

    def add(total: Column, x: Column) -> Column:
        doubled = x * 2
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    order = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    every = F.filter(order, lambda x, i: i % 2 == 1)
    plain = F.filter(order, lambda x, i: i % 2 == 0)
    return F.aggregate(every, F.lit(0), add) + F.aggregate(plain, F.lit(0), lambda t, x: t + x)


def _card(norm: Column, stream: Column) -> Column:
    body = _digits(norm, stream, F.lit(1))
    cut = F.substring(body, F.lit(1), F.length(body) - 1)
    check = F.pmod(10 - F.pmod(_luhn(F.concat(cut, F.lit("0"))), F.lit(10)), F.lit(10))
    return F.when(F.pmod(_luhn(norm), F.lit(10)) == 0, F.concat(cut, check.cast("string"))).otherwise(body)


def _syllables(parts: str, stream: Column, n: Column) -> Column:
    """So many syllables: a space that grows with every attempt."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: _pick(parts, _byte(stream, i + 6))), "")


def _core(key: str) -> Column:
    """Surrogate of an entity (type, norm) at an attempt."""
    kind, norm, attempt = F.col("type"), F.col("norm"), F.col("attempt")
    stream = _stream(key, attempt, kind, norm)
    more = F.when(attempt > 2, F.substring(F.translate(stream, "abcdef", "012345"), 1, 4)).otherwise(F.lit(""))
    at = F.instr(norm, "@")
    domain = F.substring(norm, at + 1, F.length(norm))
    host = F.regexp_replace(domain, r"\.[^.]*$", "")
    top = F.substring_index(domain, ".", -1)
    local = _same_classes(F.substring(norm, F.lit(1), at - 1), stream, F.lit(False))
    # the domain depends on itself only, until a collision asks for another
    hosts = _same_classes(host, _stream(key, F.lit(0), F.lit("domain"), domain), F.lit(False))
    email = F.concat(local, more, F.lit("@"), hosts, F.lit("."), top)
    octet = [(1 + F.pmod(_byte(stream, F.lit(2 * i)) * 256 + _byte(stream, F.lit(2 * i + 1)), F.lit(223))).cast("string") for i in range(4)]
    country = F.when(F.length(norm) > 10, F.length(norm) - 10).otherwise(F.lit(0))
    hexadecimal = norm.rlike("^[0-9a-f]+$")
    secret = F.concat(_same_classes(norm, stream, hexadecimal), more)
    head = F.when(norm.startswith("gh"), F.lit(4)).when(norm.startswith("sk-"), F.lit(3)).otherwise(F.lit(4))
    access = F.concat(F.substring(norm, F.lit(1), head), _same_classes(F.substring(norm, head + 1, F.length(norm)), stream, F.lit(False)))
    iban = F.concat(F.substring(norm, 1, 2), _same_classes(F.substring(norm, F.lit(3), F.length(norm)), stream, F.lit(False)))
    out = (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", *octet))
        .when(kind == "ipv6", F.concat_ws(":", *[F.substring(stream, 4 * i + 1, 4) for i in range(8)]))
        .when(kind == "phone", _digits(norm, stream, country))
        .when(kind == "ssn", _digits(norm, stream, F.lit(0)))
        .when(kind == "card", _card(norm, stream))
        .when(kind == "key", access)
        .when(kind == "iban", iban)
        .when(kind == "secret", secret)
    )
    for kind_of, names in GIVEN.items():
        given = _pick(names, _byte(stream, F.lit(0)))
        second = F.concat(given, F.lit("-"), _pick(names, _byte(stream, F.lit(1))))
        third = F.concat(given, F.lit("-"), F.initcap(_syllables(SYLLABLES[kind_of.split("_")[1]], stream, attempt + 1)))
        out = out.when(kind == f"given_{kind_of}", F.when(attempt == 0, given).when(attempt < 2, second).otherwise(third))
    for script, parts in SYLLABLES.items():
        picked = [_pick(parts, _byte(stream, F.lit(i))) for i in range(6)]
        name = F.concat(*picked[:3], *[F.when(attempt > 2 * i, p).otherwise(F.lit("")) for i, p in enumerate(picked[3:])])
        name = F.concat(name, F.when(attempt > 6, _syllables(parts, stream, attempt - 6)).otherwise(F.lit("")))
        out = out.when(kind == f"surname_{script}", F.initcap(name))
    return out


def _mentions(docs: DataFrame) -> DataFrame:
    """``row, pos, mention`` of every entity in the texts."""
    found = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found"))
    return found.select("row", F.posexplode("found").alias("pos", "mention"))


def _described(mentions: DataFrame) -> DataFrame:
    """Type, kept beginning, value and normal form of each distinct mention."""
    m = F.col("mention")
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(TYPES.items()):
        kind = F.when(m.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    # A mention's neighbours can matter to a pattern; what fits none alone is a number with a layout of its own.
    kind = F.coalesce(kind, F.lit("phone"))
    lead = F.when(F.col("type") == "secret", F.regexp_extract(m, f"^({_SECRET})", 1)).when(
        F.col("type") == "name", F.regexp_extract(m, f"^({_TITLE})", 1)
    )
    value = F.substring(m, F.length("lead") + 1, F.length(m))
    norm = (
        F.when(F.col("type").isin("phone", "ssn", "card"), F.regexp_replace(m, "[^0-9]", ""))
        .when(F.col("type").isin("email", "ipv6"), F.lower(m))
        .when(F.col("type") == "iban", F.regexp_replace(m, " ", ""))
        .otherwise(F.col("value"))
    )
    rows = mentions.select("mention").distinct().withColumn("type", kind)
    return rows.withColumn("lead", F.coalesce(lead, F.lit(""))).withColumn("value", value).withColumn("norm", norm)


def _name_parts(names: DataFrame) -> DataFrame:
    """``mention, pos, type, norm`` of the parts of a name: given names by gender and script, then the surname."""
    title = F.regexp_replace("lead", r"\.? $", "")
    gender = F.when(title.rlike(f"^(?:{_FEMALE})$"), "female").when(title.rlike(f"^(?:{_MALE})$"), "male").otherwise("any")
    script = F.when(F.col("value").rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    parts = names.select("mention", gender.alias("gender"), script.alias("script"), F.split(F.regexp_replace("value", rf"\b{_PARTICLE} ", ""), r"[ -]|(?<=\.)(?=\p{L})").alias("all"))
    parts = parts.select("*", F.posexplode("all").alias("pos", "part"))
    kind = F.when(F.col("pos") == F.size("all") - 1, F.concat(F.lit("surname_"), F.col("script"))).otherwise(
        F.concat(F.lit("given_"), F.col("gender"), F.lit("_"), F.col("script"))
    )
    return parts.select("mention", "pos", kind.alias("type"), F.initcap(F.regexp_replace("part", r"\.$", "")).alias("norm"))


def assigned(spark: SparkSession, entities: DataFrame, key: str) -> DataFrame:
    """``type, norm, core``: a surrogate for each distinct entity, none shared and none real."""
    entities = staged(spark, entities.select("type", "norm").distinct(), "pii-entities")
    real = entities.select("type", F.col("norm").alias("core"), F.lit(True).alias("real"))
    done, open_ = None, entities.withColumn("attempt", F.lit(0))
    for _ in range(ATTEMPTS):
        drawn = open_.withColumn("core", _core(key))
        taken = real if done is None else real.union(done.select("type", "core", F.lit(True)))
        winner = drawn.groupBy("type", "core").agg(F.min("norm").alias("winner"))
        judged = drawn.join(winner, ["type", "core"]).join(taken.distinct(), ["type", "core"], "left")
        judged = staged(spark, judged.withColumn("ok", F.col("real").isNull() & (F.col("norm") == F.col("winner"))), "pii-drawn")
        kept = judged.where("ok").select("type", "norm", "core")
        done = kept if done is None else done.union(kept)
        open_ = judged.where("not ok").select("type", "norm", (F.col("attempt") + 1).alias("attempt"))
        if open_.isEmpty():
            return done
    raise ValueError("the surrogates of a type are used up")


def replacements(spark: SparkSession, mentions: DataFrame, key: str) -> DataFrame:
    """``mention, type, surrogate`` of each distinct mention."""
    described = staged(spark, _described(mentions), "pii-mentions")
    plain, names = described.where("type <> 'name'"), _name_parts(described.where("type = 'name'"))
    table = assigned(spark, plain.select("type", "norm").union(names.select("type", "norm")), key)
    digit = F.transform(
        F.split("mention", ""),
        lambda c, i: F.when(c.rlike("^[0-9]$"), F.substring("core", F.length(F.regexp_replace(F.substring("mention", F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))).otherwise(c),
    )
    group = F.transform(
        F.split("mention", ""),
        lambda c, i: F.when(c == " ", c).otherwise(F.substring("core", F.length(F.regexp_replace(F.substring("mention", F.lit(1), i + 1), " ", "")), F.lit(1))),
    )
    rendered = (
        F.when(F.col("type").isin("phone", "ssn", "card"), F.array_join(digit, ""))
        .when(F.col("type") == "iban", F.array_join(group, ""))
        .when((F.col("type") == "email") & (F.upper("mention") == F.col("mention")), F.upper("core"))
        .otherwise(F.concat("lead", "core"))
    )
    done = plain.join(table, ["type", "norm"]).select("mention", "type", rendered.alias("surrogate"))
    parts = names.join(table, ["type", "norm"]).groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("pos", "core"))).alias("parts"))
    whole = described.where("type = 'name'").join(parts, "mention")
    whole = whole.select("mention", "type", F.concat("lead", F.array_join("parts.core", " ")).alias("surrogate"))
    return done.union(whole)


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text`` and the number of ``entities`` beside its own columns."""
    spark = docs.sparkSession
    mentions = staged(spark, _mentions(docs).distinct(), "pii-places")
    table = staged(spark, replacements(spark, mentions, key), "pii-surrogates")
    found = mentions.join(table, "mention").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "surrogate"))).alias("found"))
    joined = docs.withColumn("__row", F.xxhash64("doc_id", "text")).join(found.select(F.col("row").alias("__row"), F.col("found.surrogate").alias("__new")), "__row", "left")
    gaps = F.split("text", ANY, -1)
    text = F.array_join(F.zip_with(gaps, "__new", lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")
    return joined.select(
        *[F.when(F.col("__new").isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else docs[c] for c in docs.columns],
        F.coalesce(F.size("__new"), F.lit(0)).alias("entities"),
    )
