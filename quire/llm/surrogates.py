"""Surrogates for personal data, in SQL expressions only.

Detected entities (mail addresses, telephone, card, account and social security numbers, IP
addresses, access tokens, and names after a title or a common given name) are replaced by keyed
surrogates of the same type and look: letters for letters of the same case and script, digits for
digits, separators and mail top-level domain kept, a valid card number by a valid one, a woman's
name by a woman's name in the same script. Which gender a given name has is asked of all its
mentions, so that it has one surrogate, with or without a title that tells.

A person is a chain of titles and one to four name words, or a common given name and one or two
more; name words may have inner capitals, hyphens and apostrophes, be all capitals, and have
initials (which become X.) or particles (kept) before them. Where a text names a person so, its name words
of three letters or more are replaced wherever they stand alone in it, too. Known to stay in clear: names
with neither a title nor a listed given name anywhere in the text, fifth and later words of a name,
dates of birth, IPv6 addresses, and telephone and social security numbers of bare digits. A capitalised word
after a name is taken for a part of it.

A surrogate is a function of the key, the type and the normalised entity, so an entity has the
same surrogate wherever it is mentioned and however it is written. The distinct entities of the
corpus are checked: no two have the same surrogate, and none is another real entity; those that
would are keyed again, with a number of tries that goes into the hash, until no case is left. The hash is an
HMAC, whose key is a parameter.
Only these few numbers are joined back to the mentions; the surrogate itself is computed in place.

Edge cases: a null text stays null; texts without entities come back as they are; equal texts get
equal results; null and repeated ids do not matter; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from quire.llm.common import documents, result, written

#: For tests and examples; a caller, or the session's setting ``quire.surrogate.key``, has a secret one.
KEY = "quire-surrogate-key"
#: Parts of the mentions of one entity in the join with its number of tries.
SALT = 16

_MALE = "Mr|MR|Mister|Herr|HERR|Monsieur|Señor|Signor|Sir"
_FEMALE = "Mrs|MRS|Ms|MS|Miss|Frau|FRAU|Madame|Mme|Mademoiselle|Señora|Señorita|Signora"
_OTHER = "Dr|DR|Prof|PROF|Professor|Doctor"
_TITLE = rf"(?:{_MALE}|{_FEMALE}|{_OTHER})\.? "
_HIS = "James|John|Robert|Michael|William|David|Richard|Thomas|Charles|Daniel|Hans|Peter|Klaus|Pierre|Jean|Carlos|José|Juan|Иван|Пётр"
_HER = "Mary|Patricia|Jennifer|Linda|Elizabeth|Barbara|Susan|Jessica|Sarah|Anna|Maria|María|Marie|Claire|Ursula|Carmen|Мария|Анна"
_NAME = r"\p{Lu}\p{L}++(?:['’-]\p{Lu}\p{L}*+){0,3}|\p{Lu}(?:['’]\p{Lu}\p{L}++){1,2}"
_PARTICLE = r"(?:van|von|de|der|den|del|della|di|da|du|la|le|ten|ter|zu|bin|al|dos|y) "
_MORE = rf"(?:{_PARTICLE}){{0,3}}(?:\p{{Lu}}\. ){{0,3}}(?:{_PARTICLE}){{0,3}}(?:{_NAME})"
#: A mail domain has at most 127 labels: each repetition of a group takes a frame of Java's stack.

MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}][\p{L}\p{N}-]{0,62}\.){1,126}[\p{L}]{2,24}(?![\p{L}\p{N}])"
ACCOUNT = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
TOKEN = r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|(?=[0-9a-fA-F]{0,63}[a-fA-F])[0-9a-fA-F]{32,64})(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?<![\p{{L}}\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\d]|\.\d)"
PHONE = (r"(?<![\p{L}\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})"
         r"(?![\p{L}\d])")
SOCIAL = r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\p{L}\d-])"
CARD = r"(?<![\p{L}\d])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{13,19})(?![\p{L}\d])"
PERSON = (rf"(?<![\p{{L}}\d])(?=\p{{Lu}})(?:(?:{_TITLE}){{1,3}}{_MORE}(?: {_MORE}){{0,3}}"
          rf"|(?:{_HIS}|{_HER})(?:-\p{{Lu}}\p{{L}}++)?(?: {_MORE}){{1,2}})(?![\p{{L}}\d])")
#: No entity begins within a word; that is asked once, before all alternatives.
ENTITY = r"(?<![\p{L}\p{N}])(?:" + "|".join(["(?:" + p + ")" for p in (MAIL, ACCOUNT, TOKEN, ADDRESS, PHONE, SOCIAL, CARD, PERSON)]) + ")"
#: What may be a name by itself, and what is looked at in texts that name a person.
ALONE = rf"(?<![\p{{L}}\p{{N}}])(?:{_NAME})(?![\p{{L}}\p{{N}}])"
EITHER = ENTITY + "|" + ALONE


def _sql(text: str) -> str:
    """A string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: The name words of a person as written.
_WORDS = f"split(regexp_replace(s, {_sql('^(?:' + _TITLE + ')+')}, ''), ' ')"


_KIND = f"""CASE WHEN contains(s, '@') THEN 'mail' WHEN s RLIKE {_sql('^' + ADDRESS + '$')} THEN 'address'
 WHEN s RLIKE {_sql('^(?:' + TOKEN + ')$')} THEN 'token' WHEN s RLIKE {_sql('^[A-Z]{2}[0-9]{2}[ A-Z0-9]+$')} THEN 'account'
 WHEN s RLIKE {_sql('^[0-9]{3}-[0-9]{2}-[0-9]{4}$')} THEN 'social'
 WHEN s RLIKE {_sql('^' + CARD + '$')} THEN 'card' WHEN s RLIKE '^[+(0-9]' THEN 'phone' ELSE 'person' END"""
#: What is replaced character by character: digits of numbers (after a telephone's country code
#: and a colon), all of a mail address or token.
_NORM = """CASE kind WHEN 'mail' THEN lower(s) WHEN 'address' THEN s WHEN 'token' THEN lower(s)
 WHEN 'account' THEN replace(s, ' ', '')
 WHEN 'phone' THEN concat(regexp_replace(regexp_replace(regexp_extract(s, '^[+][0-9]+', 0), '[+]([0-9]+)', '$1:'), '^1:$', ''),
                          regexp_replace(regexp_replace(s, '^[+][0-9]+', ''), '[^0-9]', ''))
 ELSE regexp_replace(s, '[^0-9]', '') END"""

_LUHN = """aggregate(split(reverse({0}), ''), named_struct('i', 0, 't', 0), (a, c) -> named_struct('i', a.i + 1, 't', a.t
 + if(a.i % 2 = 0, cast(c as int), if(cast(c as int) > 4, 2 * cast(c as int) - 9, 2 * cast(c as int)))), a -> a.t % 10)"""


def _hash(key: str, *parts: str) -> str:
    """Hexadecimal digits that only the key's holder can compute, 64 for each 16 characters."""
    block = key.encode() if len(key.encode()) <= 64 else hashlib.sha256(key.encode()).digest()
    inner, outer = (bytes(x ^ pad for x in block.ljust(64, b"\0")).hex() for pad in (0x36, 0x5C))
    text = f"cast(concat_ws('|', {', '.join(parts)}, cast(tries as string), cast(bl as string)) as binary)"
    mac = f"sha2(concat(X'{outer}', unhex(sha2(concat(X'{inner}', {text}), 256))), 256)"
    return f"array_join(transform(sequence(0, length(norm) div 16), bl -> {mac}), '')"


def _letter(alphabet: str, value: str) -> str:
    return f"substr({_sql(alphabet)}, 1 + {value} % {len(alphabet)}, 1)"


#: The character in place of ``ch`` of a lower-cased entity, with the number ``v`` from the hash.
_CHANGED = f"""CASE WHEN ch RLIKE '[a-z]' THEN {_letter('abcdefghijklmnopqrstuvwxyz', 'v')}
 WHEN ch RLIKE '[0-9]' THEN cast(v % 10 as string) WHEN ch RLIKE '\\\\p{{IsCyrillic}}' THEN {_letter('абвгдежзиклмнопрстуфхцчшэюя', 'v')}
 WHEN ch RLIKE '\\\\p{{IsGreek}}' THEN {_letter('αβγδεζηθικλμνξοπρστυφχψω', 'v')}
 WHEN ch RLIKE '\\\\p{{L}}' THEN {_letter('àáâäèéêëìíîïòóôöùúûüçñ', 'v')} ELSE ch END"""
_HEX = f"if(ch RLIKE '[a-f]', {_letter('abcdef', 'v')}, if(ch RLIKE '[0-9]', cast(v % 10 as string), {_CHANGED}))"
_UPPER = f"if(ch RLIKE '[A-Z]', {_letter('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'v')}, if(ch RLIKE '[0-9]', cast(v % 10 as string), ch))"


def _mapped(text: str, change: str, keep: str) -> str:
    """The characters of a text changed, but for the first ``keep``."""
    value = "cast(conv(substr(h, 4 * px + 1, 4), 16, 10) as int)"
    one = f"aggregate(array({value}), '', (un, v) -> {change})"
    return f"array_join(transform(split({text}, ''), (ch, px) -> if(px < {keep}, ch, {one})), '')"


_SYLLABLE = {"latin": ("bdfgklmnprstvz", "aeiou", "n", "a"), "cyrillic": ("бвгдзклмнпрст", "аеиоу", "н", "а"),
             "greek": ("βγδζκλμνπρστ", "αειου", "ς", "α")}


def _name(script: str) -> str:
    consonants, vowels, his, her = _SYLLABLE[script]
    parts = [_letter(a, f"cast(conv(substr(h, {4 * i + 1}, 4), 16, 10) as int)") for i, a in enumerate([consonants, vowels] * 3)]
    return f"concat({', '.join(parts)}, CASE sex WHEN 'his' THEN '{his}' WHEN 'her' THEN '{her}' ELSE '' END)"


def surrogate(df: DataFrame, key: str = KEY) -> DataFrame:
    """Adds ``made``, the normalised surrogate of (kind, norm, sex, tries)."""
    df = df.withColumn("h", F.expr(_hash(key, "kind", "norm")))
    tld = "substring_index(norm, '.', -1)"
    body = "left(norm, length(norm) - length(substring_index(norm, '.', -1)))"
    digits = _mapped("norm", _CHANGED, "if(kind = 'card', 1, instr(norm, ':'))")
    df = df.withColumn("made", F.expr(f"""CASE WHEN kind = 'mail' THEN concat({_mapped(body, _CHANGED, '0')}, {tld})
 WHEN kind = 'address' THEN array_join(transform(sequence(0, 3), ox -> cast(1 + cast(conv(substr(h, 4 * ox + 1, 4), 16, 10) as int) % 254 as string)), '.')
 WHEN kind = 'token' THEN {_mapped('norm', _HEX, '0')} WHEN kind = 'account' THEN {_mapped('norm', _UPPER, '2')}
 WHEN kind IN ('given', 'family') THEN CASE WHEN norm RLIKE '\\\\p{{IsCyrillic}}' THEN {_name('cyrillic')}
 WHEN norm RLIKE '\\\\p{{IsGreek}}' THEN {_name('greek')} ELSE {_name('latin')} END ELSE {digits} END"""))
    # a valid card number stays one: its last digit makes the sum
    front = "left(made, length(made) - 1)"
    check = f"cast((10 - {_LUHN.format(f'concat({front}, 0)')}) % 10 as string)"
    valid = _LUHN.format("norm") + " = 0"
    return df.withColumn("made", F.expr(f"if(kind = 'card' and {valid}, concat({front}, {check}), made)")).drop("h")


def mentions(docs: DataFrame) -> DataFrame:
    """(h1, h2, s, px, kind, norm, sex): the parts of each entity mentioned; a person has one for each
    name word, all others one. Equal texts are one document here."""
    person = f"s RLIKE {_sql('^(?:' + PERSON + ')$')}"
    found = docs.select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"), "text",
                        F.expr(f"array_distinct(regexp_extract_all(text, {_sql(ENTITY)}, 0))").alias("all")).filter(F.size("all") > 0)
    found = found.withColumn("people", F.expr(f"transform(filter(all, s -> {person}), s -> {_WORDS})"))
    found = found.withColumn("family", F.expr("array_distinct(transform(people, w -> element_at(w, -1)))"))
    found = found.withColumn("alone", F.expr(
        f"if(size(people) = 0, array(), array_intersect(filter(flatten(people), w -> w RLIKE '^\\\\p{{Lu}}.{{2}}'), regexp_extract_all(text, {_sql(ALONE)}, 0)))"))
    every = F.expr("""concat(transform(all, s -> named_struct('s', s, 'as', cast(null as string))),
 transform(array_intersect(alone, family), s -> named_struct('s', s, 'as', 'family')),
 transform(array_except(alone, family), s -> named_struct('s', s, 'as', 'given')))""")
    # a copied text's entities are the same: one row for each text and surface
    rows = found.select("h1", "h2", F.explode(every).alias("e")).select("h1", "h2", "e.s", "e.as").distinct()
    rows = rows.withColumn("kind", F.expr(f"if(as is not null, 'person', {_KIND})")).withColumn("nm", F.expr(_WORDS))
    sex = (f"CASE WHEN s RLIKE {_sql(rf'^(?:(?:{_OTHER})[.]? )*(?:{_MALE})(?![\p{{L}}])')} OR nm[0] RLIKE {_sql(f'^(?:{_HIS})(?![^-])')} THEN 'his' "
           f"WHEN s RLIKE {_sql(rf'^(?:(?:{_OTHER})[.]? )*(?:{_FEMALE})(?![\p{{L}}])')} OR nm[0] RLIKE {_sql(f'^(?:{_HER})(?![^-])')} THEN 'her' END")
    parts = F.expr(f"""if(kind = 'person', filter(transform(nm, (w, i) -> named_struct('px', i, 'kind',
 coalesce(as, if(i = size(nm) - 1, 'family', 'given')), 'norm', lower(w), 'sex', if(i = size(nm) - 1 and as is null, null, {sex}))),
 w -> nm[w.px] RLIKE '^\\\\p{{Lu}}[^.]'), array(named_struct('px', 0, 'kind', kind, 'norm', {_NORM}, 'sex', cast(null as string))))""")
    return rows.select("h1", "h2", "s", F.explode(parts).alias("part")).select("h1", "h2", "s", "part.*")


def tries(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm, sex, tries) of the distinct entities (kind, norm, sex) whose gender is known or whose
    first surrogate would be another entity or another's surrogate; the others need none."""
    counts = [F.count(F.when(F.col("sex") == x, 1)).alias(x) for x in ("his", "her")]
    every = entities.groupBy("kind", "norm").agg(*counts).withColumn(
        "sex", F.expr("CASE WHEN her > his THEN 'her' WHEN his > 0 THEN 'his' ELSE '' END")).drop("his", "her")
    every = written(every, "entities")
    name = F.col("kind").isin("given", "family")
    pool = F.when(name, "name").otherwise(F.col("kind")).alias("pool")
    real = every.select(pool, F.col("norm").alias("made"), F.lit(True).alias("real")).distinct()
    now = written(surrogate(every.withColumn("tries", F.lit(0)), key), "made")
    while True:
        order = Window.partitionBy("pool", "made").orderBy("tries", "kind", "norm")
        judged = (now.select("*", pool).join(real, ["pool", "made"], "left")
                  .withColumn("bad", F.col("real").isNotNull() | (F.row_number().over(order) > 1)))
        judged = written(judged.select("kind", "norm", "sex", "tries", "made", "bad"), "judged")
        if judged.filter("bad").isEmpty():
            return judged.filter("tries > 0 or sex <> ''").select("kind", "norm", "sex", "tries")
        again = surrogate(judged.filter("bad").select("kind", "norm", "sex", (F.col("tries") + 1).alias("tries")), key)
        now = written(judged.filter("not bad").select(again.columns).unionByName(again), "made")


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(doc_id, text, n_entities, kinds): the text with its entities replaced, the number of
    mentions replaced, and their types."""
    parts = written(mentions(docs), "mentions")
    more = tries(parts.select("kind", "norm", "sex"), key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    dealt = parts.drop("sex").withColumn("salt", F.pmod("h1", F.lit(SALT)).cast("int"))
    made = surrogate(dealt.join(more, ["kind", "norm", "salt"], "left")
                     .withColumn("tries", F.coalesce("tries", F.lit(0))).withColumn("sex", F.coalesce("sex", F.lit(""))), key)
    # digits and letters of the surrogate go where the entity as written has them, after the 1 of a telephone number
    own = "if(kind IN ('mail', 'token', 'account'), ch <> ' ', ch RLIKE '[0-9]')"
    made = made.withColumn("dg", F.expr("if(kind = 'phone' and not contains(norm, ':') and s RLIKE '^[+]1', concat('1', made), replace(made, ':', ''))"))
    put = (f"aggregate(split(s, ''), named_struct('t', '', 'i', 0), (a, ch) -> if({own}, named_struct('t', concat(a.t, "
           f"if(ch RLIKE '\\\\p{{Lu}}', upper(substr(dg, a.i + 1, 1)), substr(dg, a.i + 1, 1))), 'i', a.i + 1), "
           f"named_struct('t', concat(a.t, ch), 'i', a.i)), a -> a.t)")
    written_as = F.expr(f"CASE WHEN kind = 'address' THEN made WHEN kind IN ('given', 'family') THEN made ELSE {put} END")
    made = made.select("h1", "h2", "s", "px", "kind", written_as.alias("new"))
    whole = made.groupBy("h1", "h2", "s").agg(F.map_from_entries(F.collect_list(F.struct("px", "new"))).alias("p"), F.min("kind").alias("kind"))
    whole = whole.withColumn("kind", F.when(F.col("kind").isin("given", "family"), "person").otherwise(F.col("kind")))
    title = f"regexp_extract(s, {_sql('^(?:' + _TITLE + ')*')}, 0)"
    word = ("if(p[i] is not null, if(length(w) > 1 and w = upper(w), upper(p[i]), initcap(p[i])), "
            "if(w RLIKE '^\\\\p{Lu}[.]$', 'X.', w))")
    whole = whole.select("h1", "h2", "s", "kind", F.expr(
        f"if(kind = 'person', concat({title}, array_join(transform({_WORDS}, (w, i) -> {word}), ' ')), p[0])").alias("new"))
    maps = whole.groupBy("h1", "h2").agg(F.map_from_entries(F.collect_list(F.struct("s", "new"))).alias("new"),
                                         F.array_sort(F.collect_set("kind")).alias("kinds"))
    rows = docs.select("doc_id", "text").withColumn("some", F.expr(f"text RLIKE {_sql(ENTITY)}"))
    plain = rows.filter("text is null or not some").select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    rest = rows.filter("some").withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(7), "text"))
    rest = rest.join(maps, ["h1", "h2"])
    def by_kind(call: str, last: int) -> Column:
        named, other = (f"{call}(text, {_sql(pattern)}, {last})" for pattern in (EITHER, ENTITY))
        return F.expr(f"if(array_contains(kinds, 'person'), {named}, {other})")

    rest = rest.withColumn("all", by_kind("regexp_extract_all", 0)).withColumn("between", by_kind("split", -1))
    return plain.unionByName(rest.select(
        "doc_id", F.expr("array_join(zip_with(between, all, (g, e) -> concat(g, coalesce(new[e], e, ''))), '')").alias("text"),
        F.expr("cast(size(filter(all, e -> new[e] is not null)) as long)").alias("n_entities"), "kinds"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result(lambda: replaced(documents(spark, sf_dir), spark.conf.get("quire.surrogate.key", KEY)), "op7")
