"""PII surrogates: entities replaced by keyed stand-ins of the same kind and format, distinct for distinct entities."""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume.llm.common import attach, opened, saved, sealed

# Titles, of which some don't tell the gender, and the given names that stand in after them.
MALE_TITLES = ["Mr", "Herr", "Señor", "Monsieur"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame"]
OTHER_TITLES = ["Dr", "Prof", "Professor", "Doctor", "Rev", "Judge", "Senator"]
MALE_NAMES = ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Noah",
              "Oscar", "Paul", "Robert", "Simon", "Thomas", "Victor"]
FEMALE_NAMES = ["Alice", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Irene", "Julia", "Karen", "Laura", "Maria",
                "Nora", "Olivia", "Paula", "Rosa", "Sofia", "Teresa", "Vera"]

# Letters that stand in for letters of a script, by the script's name in patterns. Letters of other scripts become Latin.
ALPHABETS = [
    ("IsLatin", "aeiou"), ("IsCyrillic", "абвгдежзиклмнопрстуфхцчшэюя"), ("IsGreek", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("IsHan", "安白成德芳國華建林明平青山文新雲"), ("IsArmenian", "աբգդեզէթիլխկհձղճմյնշոպջռսվտրփք"), ("IsGeorgian", "აბგდევზთიკლმნოპრსტუფქღშჩცძწჭხჯ"),
    ("IsHebrew", "אבגדהוזחטיכלמנסעפצקרשת"), ("IsArabic", "ابتثجحخدذرزسشصطعغفقكلمنهوي"), ("IsDevanagari", "अआइकखगघचछजटठडढतथदधनपफबमयरलवशसह"),
    ("IsThai", "กขคงจชซดตถทนบปผพฟมยรลวสหอ"), ("IsHiragana", "あいうえおかきくけこさしすせそたちつてとなにのはひほまみもやゆよらりるろわ"),
    ("IsKatakana", "アイウエオカキクケコサシスセソタチツテトナニノハヒホマミモヤユヨラリルロワ"), ("IsHangul", "가강고구규기김나노도라마문민박배서성소수신안영우유윤은이정조주지진최하현"),
]

TITLES = "|".join(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES)
WORD = r"(?:\p{Lu}[\p{L}\p{M}'-]+|[\p{Lo}\p{IsGeorgian}][\p{L}\p{M}'-]*)"
HEX = "[0-9A-Fa-f]{1,4}"
PATTERNS = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9.-]*[A-Za-z0-9]\.[A-Za-z]{2,}"),
    ("ipv6", rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}})(?![0-9A-Za-z:])"),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![0-9A-Za-z])"),
    ("card", r"(?<![0-9A-Za-z+-])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}|[0-9]{13,19})(?![0-9A-Za-z]|-[0-9])"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"),
    ("phone", r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"),
    ("abroad", r"(?<![0-9A-Za-z+])\+(?=(?:[ .()-]{0,2}[0-9]){8,15}(?![0-9]))[1-9][0-9]{0,2}(?:[ .-]?(?:\([0-9]{1,5}\)|[0-9]{1,12})){1,6}(?![0-9A-Za-z])"),
    ("name", rf"(?<![\p{{L}}])(?:{TITLES})\.? {WORD}(?: {WORD}){{0,2}}"),
    ("secret", r"(?<=(?:token|secret|password) ?= ?\")[0-9A-Za-z_-]{16,}(?=\")"),
]
ENTITY = "|".join(f"(?:{p})" for _, p in PATTERNS)
HINT = r"@|[0-9]{3}|[0-9]\.[0-9]|\+[0-9]|= ?\"|:[0-9A-Fa-f]{0,4}:|[A-Z]{2}[0-9]{2}|(?:" + TITLES + r")\.? "
FREE_AFTER = 8  # attempts that keep the exact length; later ones may widen it


def mentions(text: Column) -> Column:
    """All entities of a text in order, as written. A cheap pattern first passes over texts that can have none."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def last_word(name: Column) -> Column:
    return F.element_at(F.split(name, " "), -1)


def surnames(found: Column) -> Column:
    """The last names of the titled names among mentions: they count alone, too, in the same text."""
    return F.array_distinct(F.transform(F.filter(found, lambda m: m.rlike(rf"^({TITLES})\.? ")), last_word))


def pattern(names: Column) -> Column:
    """ENTITY, with the last names of a text."""
    alone = F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{M}'-])(?:"), F.array_join(names, "|"), F.lit(r")(?![\p{L}\p{M}'-])"))
    return F.when(F.size(names) > 0, alone).otherwise(ENTITY)


def kind_of(m: Column) -> Column:
    """The kind of a mention. A number of 13 to 19 digits in one, but not 16, is a card only if its check digit is right."""
    digits = F.regexp_replace(m, "[ -]", "")
    valid = F.expr(f"right(digits_, 1) = cast({_luhn('digits_')} as string)")
    long = m.rlike(r"^[0-9]{13,19}$|^[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}$")
    return (F.when(m.contains("@"), "email").when(m.rlike(r"^[0-9]+(\.[0-9]+){3}$"), "ip")
            .when(m.rlike(rf"^({TITLES})\.? "), "name").when(m.rlike(r"^[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"), "card")
            .when(long, F.when(valid, "card").otherwise("number"))
            .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn").when(m.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9 ]+$") & (F.length(digits) <= 34), "iban")
            .when(m.contains(":"), "ipv6").when(m.rlike(r"^[0-9A-Za-z_-]{16,}$"), "secret").otherwise("phone"))


def canonical(m: Column, kind: Column) -> Column:
    """What all mentions of an entity have in common: letter case, separators and the country code 1 of a phone don't count. A name
    has its gender in front: m, f, or n where the title doesn't tell."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    gender = F.when(m.rlike(rf"^({'|'.join(MALE_TITLES)})\.? "), "m").when(m.rlike(rf"^({'|'.join(FEMALE_TITLES)})\.? "), "f").otherwise("n")
    bare = F.lower(F.regexp_replace(m, rf"^({TITLES})\.? ", ""))
    abroad = m.startswith("+") & ~(digits.startswith("1") & (F.length(digits) == 11)) & (F.length(digits) != 10)
    return (F.when(kind.isin("email", "ipv6"), F.lower(m)).when(kind == "name", F.concat(gender, F.lit(":"), bare))
            .when(kind == "phone", F.when(abroad, F.concat(F.lit("+"), digits)).otherwise(F.right(digits, F.lit(10))))
            .when(kind == "iban", F.regexp_replace(m, " ", "")).when(kind.isin("card", "ssn"), digits).otherwise(m))


def resolved(places: DataFrame) -> DataFrame:
    """places (k1, k2, mention, bare, kind, canon) with short forms of names led back to a full name of the same text: a title with the
    last name to one of the same gender or of none, a bare last name to any. Without a full name, bare ones go with the titled one."""
    in_text = Window.partitionBy("k1", "k2", last_word(F.col("canon").substr(F.lit(3), F.length("canon"))))
    full = F.col("canon").contains(" ") & ~F.col("bare")
    gender = F.left("canon", F.lit(1))

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, F.col("canon"))).over(in_text)

    of = {g: first(full & (gender == g)) for g in "mfn"}
    same = F.when(gender == "m", of["m"]).when(gender == "f", of["f"])
    titled = F.coalesce(same, of["n"], F.when(gender == "n", first(full)), F.col("canon"))
    names = places.where("kind = 'name'").withColumn("canon", F.when(full, F.col("canon")).when(
        F.col("bare"), F.coalesce(first(full), first(~F.col("bare")))).otherwise(titled))
    return places.where("kind <> 'name'").unionByName(names)


def _pick(alphabet: str, draw: str) -> str:
    return f"substr('{alphabet}', 1 + ({draw}) % {len(alphabet)}, 1)"


def _per_char(value: str, digest: str, keep: str = "false") -> str:
    """SQL: each letter or digit of value replaced by one of its kind and script, chosen by the digest."""
    draw = f"cast(conv(substr({digest}, 1 + (i * 2) % 126, 2), 16, 10) as int) + 7 * (i div 63)"
    c = f"substr({value}, i, 1)"
    scripts = " ".join(f"when {c} rlike '\\\\p{{{script}}}' then {_pick(letters, draw)}" for script, letters in ALPHABETS)
    return (f"array_join(transform(sequence(1, length({value})), i -> case when {keep} then {c} when {c} rlike '[0-9]' then {_pick('0123456789', draw)} "
            f"when {c} rlike '[aeiou]' then {_pick('aeiou', draw)} when {c} rlike '[a-z]' then {_pick('bcdfghjklmnpqrstvwxyz', draw)} "
            f"when {c} rlike '[AEIOU]' then {_pick('AEIOU', draw)} when {c} rlike '[A-Z]' then {_pick('BCDFGHJKLMNPQRSTVWXYZ', draw)} "
            f"{scripts} when {c} rlike '\\\\p{{L}}' then {_pick('bcdfghjklmnpqrstvwxyz', draw)} else {c} end), '')")


def _luhn(value: str) -> str:
    """SQL: the check digit that makes value valid, from the digits before its last."""
    digit = f"cast(substr({value}, i, 1) as int)"
    return (f"((10 - aggregate(sequence(1, length({value}) - 1), 0, (s, i) -> s + case when (length({value}) - i) % 2 = 0 then {digit} "
            f"when {digit} > 4 then 2 * {digit} - 9 else 2 * {digit} end) % 10) % 10)")


def _iban_check(value: str) -> str:
    """SQL: the two check digits of an account number that begins with its country."""
    turned = f"concat(substr({value}, 5), left({value}, 2), '00')"
    worth = f"case when substr({turned}, i, 1) rlike '[0-9]' then cast(substr({turned}, i, 1) as int) else ascii(substr({turned}, i, 1)) - 55 end"
    rest = f"aggregate(sequence(1, length({value})), 0, (s, i) -> (s * (case when {worth} > 9 then 100 else 10 end) + {worth}) % 97)"
    return f"lpad(cast(98 - {rest} as string), 2, '0')"


def keyed_digest(key: str, *parts: Column) -> Column:
    """HMAC with SHA-512 of the parts, in hex."""
    secret = key.encode()
    secret = (hashlib.sha512(secret).digest() if len(secret) > 128 else secret).ljust(128, b"\0")
    inner, outer = (F.unhex(F.lit(bytes(b ^ pad for b in secret).hex())) for pad in (0x36, 0x5C))
    told = F.concat_ws("|", *parts).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, told), 512))), 512)


def _names(names: list[str], digest: str) -> str:
    listed = ", ".join(f"'{n.lower()}'" for n in names)
    return f"element_at(array({listed}), 1 + cast(conv(substr({digest}, 1, 6), 16, 10) as int) % {len(names)})"


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """entities (kind, canon, attempt) with stand_in, drawn from a digest of the key, the entity and the attempt."""
    e = entities.withColumn("digest", keyed_digest(key, F.col("kind"), F.col("canon"), F.col("attempt").cast("string")))
    wide = f"case when attempt >= {FREE_AFTER} and kind in ('email', 'name', 'secret') then 'lomi' else '' end"
    e = e.withColumn("base", F.expr(f"case when kind = 'name' then concat({wide}, substr(canon, 3)) else concat({wide}, canon) end"))
    e = e.withColumn("tld", F.expr("length(base) - locate('.', reverse(base)) + 1"))
    email = _per_char("base", "digest", "i >= tld")
    card = _per_char("base", "digest", "i = 1")
    e = e.withColumn("card", F.when(F.col("kind") == "card", F.expr(card)))
    check, own = _luhn("card"), f"right(card, 1) = cast({_luhn('card')} as string)"
    card = (f"concat(left(card, length(card) - 1), case when right(canon, 1) = cast({_luhn('canon')} as string) then cast({check} as string) "
            f"when {own} then cast(({check} + 1) % 10 as string) else right(card, 1) end)")
    e = e.withColumn("account", F.when(F.col("kind") == "iban", F.expr(_per_char("upper(canon)", "digest", "i < 5"))))
    iban = f"concat(left(account, 2), {_iban_check('account')}, substr(account, 5))"
    draw = "cast(conv(substr(digest, 1 + (i * 2) % 126, 2), 16, 10) as int) + 7 * (i div 63)"
    ipv6 = (f"array_join(transform(sequence(1, length(canon)), i -> case when substr(canon, i, 1) rlike '[0-9]' then {_pick('123456789', draw)} "
            f"when substr(canon, i, 1) rlike '[a-f]' then {_pick('abcdef', draw)} else substr(canon, i, 1) end), '')")
    abroad = _per_char("canon", "digest", "i < 4")
    octet = "cast(conv(substr(digest, 1 + i * 4, 4), 16, 10) as int)"
    ip = (f"array_join(transform(split(canon, '[.]'), (o, i) -> cast(case when attempt >= {FREE_AFTER} then 1 + {octet} % 254 when length(o) = 1 then 1 + {octet} % 9 "
          f"when length(o) = 2 then 10 + {octet} % 90 else 100 + {octet} % 155 end as string)), '.')")
    given = (f"case left(canon, 1) when 'm' then {_names(MALE_NAMES, 'digest')} when 'f' then {_names(FEMALE_NAMES, 'digest')} "
             f"else {_names(MALE_NAMES + FEMALE_NAMES, 'digest')} end")
    latin = "base rlike '^[\\\\p{IsLatin}\\' -]+$'"
    e = e.withColumn("last_", F.expr("case when kind = 'name' and instr(base, ' ') > 0 then substr(base, instr(base, ' ') + 1) else base end"))
    name = (f"concat(left(canon, 2), case when instr(base, ' ') > 0 then concat(case when {latin} then {given} else {_per_char('substring_index(base, chr(32), 1)', 'reverse(digest)')} end, "
            f"' ', {_per_char('last_', 'digest')}) else {_per_char('base', 'digest')} end)")
    plain = _per_char("base", "digest")
    return e.withColumn("stand_in", F.expr(
        f"case kind when 'email' then {email} when 'ip' then {ip} when 'card' then {card} when 'name' then {name} when 'iban' then {iban} when 'ipv6' then {ipv6} "
        f"else case when left(canon, 1) = '+' then {abroad} else {plain} end end"
    )).select("kind", "canon", "attempt", "stand_in")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """entities (kind, canon) with stand_in: no two share one and none is itself an entity. What collides is drawn again, in
    rounds, until nothing does; each round sees only what is left. Who keeps a contested one is settled by order of canon."""
    entities = saved(entities)
    left, done = entities.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = surrogates(left, key).withColumn("late", F.lit(1))
        real = entities.select("kind", F.col("canon").alias("stand_in"), F.lit(True).alias("real"))
        drawn = drawn.join(real, ["kind", "stand_in"], "left")
        if done is not None:
            held = done.select("kind", "canon", F.lit(0).alias("attempt"), "stand_in", F.lit(0).alias("late"), F.lit(None).cast("boolean").alias("real"))
            drawn = drawn.select(*held.columns).unionByName(held)
        first = F.row_number().over(Window.partitionBy("kind", "stand_in").orderBy("late", "canon")) == 1
        drawn = saved(drawn.withColumn("ok", first & F.col("real").isNull()).where("late = 1"))
        good = drawn.where("ok").select("kind", "canon", "stand_in")
        done = good if done is None else done.unionByName(good)
        left = drawn.where("not ok").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if left.isEmpty():
            return done


def rendered(m: Column, kind: Column, stand_in: Column) -> Column:
    """The stand-in in the format of a mention: its separators, country code, title and letter case; of a name as much as the mention
    has of it."""
    digit = "length(regexp_replace(substr(mention, 1, i), '[^0-9]', ''))"
    digits = "regexp_replace(stand_in, '[^0-9]', '')"
    at = f"({digit} - length(regexp_replace(mention, '[^0-9]', '')) + length({digits}))"
    filled = F.expr(f"array_join(transform(sequence(1, length(mention)), i -> case when substr(mention, i, 1) rlike '[0-9]' and {at} > 0 "
                    f"then substr({digits}, {at}, 1) else substr(mention, i, 1) end), '')")
    place = "length(regexp_replace(substr(mention, 1, i), ' ', ''))"
    spaced = F.expr(f"array_join(transform(sequence(1, length(mention)), i -> case when substr(mention, i, 1) = ' ' then ' ' "
                    f"else substr(stand_in, {place}, 1) end), '')")
    loud = (F.upper(m) == m) & (F.lower(m) != m)
    title = F.regexp_extract(m, rf"^({TITLES})\.? ", 0)
    own = F.regexp_replace(m, rf"^({TITLES})\.? ", "")
    whole = F.initcap(F.expr("substr(stand_in, 3)"))
    part = F.when(own.contains(" "), whole).otherwise(last_word(whole))
    name = F.concat(title, F.when((F.upper(own) == own) & (F.lower(own) != own), F.upper(part)).otherwise(part))
    return (F.when(kind.isin("phone", "card", "ssn"), filled).when(kind == "name", name).when(kind == "iban", spaced)
            .when(kind.isin("email", "ipv6") & loud, F.upper(stand_in)).otherwise(stand_in))


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with `text` rewritten and n_entities, the mentions replaced in it.

    Emails, IPv4 and IPv6 addresses, payment cards (13 to 19 digits), account numbers (IBAN), social security and phone numbers,
    secrets and titled names are found by pattern. In a text, a title with a last name, and that last name alone, stand for the full
    name found there. Mentions of one entity (however written) get one stand-in throughout the corpus, different entities different
    ones, checked over all documents; it is drawn by HMAC with the caller's key, so without the key it can't be guessed from the
    entity. Digits stand for digits, letters for letters of their script (Latin ones for scripts without an alphabet here), vowels for
    vowels; a card keeps its first digit and the validity of its check digit, an account its country and valid check digits, an IPv4
    address the lengths of its parts, an email its top-level domain, a phone its country code (two digits of it abroad), a name its
    title and a given name of its gender. A long number that is no valid card stays.

    Only documents with entities shuffle; a frequent mention is dealt out by salt. Null texts stay null and empty ones empty, with
    0 entities. Repeated rows are rewritten alike. An empty table gives an empty result. Other columns are kept; one named
    n_entities is replaced.
    """
    docs = docs.drop("n_entities")
    rows, names = sealed(docs)
    body = F.col(names[text])
    some = F.coalesce(body.rlike(HINT) & body.rlike(ENTITY), F.lit(False))
    keyed = rows.withColumns({"k1": F.xxhash64(*names.values()), "k2": F.xxhash64(F.lit(1), body)})
    found = keyed.where(some).withColumn("names_", surnames(mentions(body))).select(
        "k1", "k2", "names_", F.regexp_extract_all(body, pattern(F.col("names_")), F.lit(0)).alias("found"))
    hits = saved(found.dropDuplicates(["k1", "k2"]))
    places = hits.select("k1", "k2", "names_", F.posexplode("found").alias("pos", "mention")).withColumn("bare", F.array_contains("names_", F.col("mention")))
    places = places.withColumn("digits_", F.regexp_replace("mention", "[ -]", "")).withColumn(
        "kind", F.when(F.col("bare"), "name").otherwise(kind_of(F.col("mention"))))
    places = saved(resolved(places.withColumn("canon", canonical(F.col("mention"), F.col("kind"))).drop("digits_", "names_")))
    distinct = saved(places.where("kind <> 'number'").select("mention", "kind", "canon").distinct())
    drawn = assign(distinct.select("kind", "canon").distinct(), key)
    replace = saved(attach(distinct, drawn, ["kind", "canon"], ["mention"]).select(
        "mention", "canon", rendered(F.col("mention"), F.col("kind"), F.col("stand_in")).alias("new")))
    news = attach(places, replace, ["mention", "canon"], ["k1", "k2", "pos"], how="left")
    lists = news.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("new", "mention").alias("new")))).alias("news"),
                                         F.count("new").alias("n_")).join(hits.select("k1", "k2", "names_"), ["k1", "k2"])
    joined = keyed.where(some).join(lists.select("k1", "k2", "names_", "n_", F.col("news.new").alias("news")), ["k1", "k2"])
    gaps = F.split(body, pattern(F.col("names_")), -1)
    whole = F.array_join(F.zip_with(gaps, "news", lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), "")
    changed = joined.withColumn(names[text], whole)
    columns = [*names.values(), "n_"]
    out = rows.where(~some).withColumn("n_", F.lit(0).cast("long")).select(*columns).unionByName(changed.select(*columns))
    return opened(out, names, F.col("n_").alias("n_entities"))
