"""Personal data replaced by keyed surrogates, with SQL functions alone.

Every mention found in a text names an entity: a kind and a canonical form
(digits of a number, lower case of an address or a name part), so mentions in
different spellings are one entity. Each distinct entity of the corpus gets one
surrogate, drawn by a keyed hash: same kind, same shape, same script and gender,
never a value that occurs in the corpus. Two entities never share a surrogate:
candidates that collide with each other, with an earlier surrogate or with a real
entity are drawn again with the next attempt number. Mentions are then written
in the format they were found in.

Texts without mentions never move; others look their surrogates up by a hash of
the text, so a thousand copies of a text ask once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from daypanel.llm import common

STALLED = 16  # attempts in a row that win no entity a surrogate: there are no more of the shape

# What a mention looks like. Look-behinds let a pattern start only
# where a run starts, and possessive quantifiers keep long runs linear.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_CAPITAL = r"\p{Lu}[\p{L}'’-]*+"
# Honorifics by gender, and given names that start a full name without one.
FEMALE_TITLES = ("Mrs", "Ms", "Frau", "Mme", "Madame", "Señora", "Sra", "г-жа", "госпожа", "κυρία")
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин", "κύριος")
NEUTRAL_TITLES = ("Dr", "Prof")
FEMALE_NAMES = ("Mary", "Anna", "Maria", "Emma", "Laura", "Sarah", "Julia", "Sophie", "Alice", "Claire", "Elena", "Lucia",
                "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Karen", "Nancy", "Lisa", "Margaret",
                "Sandra", "Emily", "Michelle", "Amanda", "Rebecca", "Catherine", "Helen", "Olivia", "Rachel", "Monika", "Petra",
                "Sabine", "Ursula", "Renate", "Claudia", "Susanne", "Katharina", "Christina", "Brigitte", "Heike", "Nicole",
                "Nathalie", "Isabelle", "Sylvie", "Valérie", "Camille", "Chloé", "Léa", "Manon", "Juliette", "Hélène", "Céline",
                "Carmen", "Ana", "Isabel", "Dolores", "Pilar", "Teresa", "Cristina", "Marta", "Rosa", "Sofía", "Lucía", "María",
                "Paula", "Анна", "Мария", "Елена", "Ольга", "Μαρία", "Ελένη")
MALE_NAMES = ("John", "James", "Peter", "Paul", "Thomas", "Michael", "David", "Hans", "Jean", "Pierre", "Carlos", "Juan",
              "Robert", "William", "Richard", "Joseph", "Charles", "Christopher", "Daniel", "Matthew", "Anthony", "Mark", "Steven",
              "Andrew", "Kevin", "Brian", "George", "Edward", "Timothy", "Jason", "Henry", "Wolfgang", "Klaus", "Jürgen", "Günter",
              "Stefan", "Andreas", "Christian", "Markus", "Matthias", "Uwe", "Heinz", "Karl", "Friedrich", "Johannes", "Lukas",
              "Philippe", "Alain", "Nicolas", "François", "Laurent", "Julien", "Antoine", "Jacques", "Michel", "Louis", "Luc",
              "José", "Antonio", "Manuel", "Francisco", "Javier", "Miguel", "Pedro", "Luis", "Alejandro", "Fernando", "Diego",
              "Pablo", "Jorge", "Rafael",
              "Иван", "Пётр", "Сергей", "Алексей", "Γιώργος", "Νίκος")
_TITLES = "|".join((*FEMALE_TITLES, *MALE_TITLES, *NEUTRAL_TITLES))
_LEAD = rf"(?:(?:{_TITLES})\.? )"  # "Frau Dr. " is two of them
_GIVEN = "|".join((*FEMALE_NAMES, *MALE_NAMES))

PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "card": (r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}"
             r"|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7})(?![0-9A-Za-z])"),
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "phone": (r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
              r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
              # As written within France, Spain, and Germany or Britain.
              r"|(?<![0-9][ .-])(?:0[1-9](?:[ .-][0-9]{2}){4}|[679][0-9]{2}(?: [0-9]{3}){2}|[679][0-9]{2}(?: [0-9]{2}){3}"
              r"|0[1-9][0-9]{1,3}[ /-][0-9]{5,8}|0[1-9][0-9]{1,3}[ /-][0-9]{3,4}[ -][0-9]{3,4})(?![ .-][0-9]))(?![0-9A-Za-z])"),
    "name": (rf"(?<!\p{{L}})(?:{_LEAD}++(?!(?:{_TITLES})(?!\p{{L}})){_CAPITAL}(?: {_CAPITAL})*+"
             rf"|(?=\p{{Lu}})(?:{_GIVEN})(?: {_CAPITAL})++)(?!\p{{L}})"),
}
KINDS = tuple(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# A cheap test that every mention passes.
HINT = rf"[0-9@]|(?<!\p{{L}})(?:{_TITLES}|{_GIVEN})[. ]"

_LATIN = tuple("ba be bi do du fa fe ga go ka ke la li lo ma me mi na ne no pa pe ra re ri ro sa se ta te to va".split())
_CYRILLIC = tuple("ба ве ви го да де ди до за ка ки ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са та то".split())
_GREEK = tuple("βα βε γα γο δα δε δι ζα ζε θα θε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα ρα ρο σα τα".split())


def _script(part: Column) -> Column:
    return F.when(part.rlike(r"\p{IsCyrillic}"), "cyrillic").when(part.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _kind_of(mention: Column) -> Column:
    return reduce(lambda found, kind: found.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind), KINDS[1:],
                  F.when(mention.rlike(f"^(?:{PATTERNS[KINDS[0]]})$"), KINDS[0])).otherwise(KINDS[-1])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _part(kind: Column, canonical: Column, gender: Column, script: Column) -> Column:
    return F.struct(kind.alias("kind"), canonical.alias("canonical"), gender.alias("gender"), script.alias("script"))


def _parts(mention: Column) -> Column:
    """The entities a mention names: one, or a given name and a surname."""
    kind, no = _kind_of(mention), F.lit("")
    words = _words(mention)
    given = F.element_at(words, 1)
    female = mention.rlike(rf"^(?:{'|'.join(FEMALE_TITLES)})[. ]") | given.isin(*FEMALE_NAMES)
    male = mention.rlike(rf"^(?:{'|'.join(MALE_TITLES)})[. ]") | given.isin(*MALE_NAMES)
    # A given name's gender is its own where known, so it is one entity under any title.
    gender = (F.when(given.isin(*FEMALE_NAMES), "f").when(given.isin(*MALE_NAMES), "m")
              .when(female, "f").when(male, "m").otherwise("n"))
    name_parts = F.transform(words, lambda w, i: _part(
        F.when((i == 0) & (F.size(words) > 1), "given").otherwise("surname"), F.lower(w),
        F.when((i == 0) & (F.size(words) > 1), gender).otherwise("n"), _script(w)))
    canonical = (F.when(kind == "email", F.lower(mention)).when(kind == "iban", F.replace(mention, F.lit(" "), no))
                 .when(kind == "ip", mention).otherwise(_digits(mention)))
    return F.when(kind == "name", name_parts).otherwise(F.array(_part(kind, canonical, F.lit("n"), F.lit("latin"))))


def _entity_key(part: Column) -> Column:
    return F.concat_ws("|", part["kind"], part["canonical"], part["gender"])


# ---- surrogates --------------------------------------------------------------

def _byte(hashed: Column, i: Column) -> Column:
    """The i-th byte of a hash in hex, taken round and round."""
    return F.conv(F.substr(hashed, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _shaped(text: Column, hashed: Column, fixed: Column) -> Column:
    """Each digit and letter after the first ``fixed`` characters drawn anew,
    within its class; everything else as it is."""
    def one(c: Column, i: Column) -> Column:
        n = _byte(hashed, i)
        return (F.when(i < fixed, c).when(c.rlike("[0-9]"), (n % 10).cast("string"))
                .when(c.rlike("[a-z]"), F.char(n % 26 + 97)).when(c.rlike("[A-Z]"), F.char(n % 26 + 65)).otherwise(c))
    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column) -> Column:
    """The sum of a number's digits, every second from the right doubled."""
    turned = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    each = F.transform(turned, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def _spelled(hashed: Column, script: Column, gender: Column, n: Column) -> Column:
    """A name of ``n`` syllables in a script, with an ending of the gender."""
    def of(syllables, endings):
        table = F.array(*map(F.lit, syllables))
        body = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(
            table, _byte(hashed, i) % len(syllables) + 1)), "")
        return F.concat(body, F.when(gender == "f", endings[0]).when(gender == "m", endings[1]).otherwise(endings[2]))
    return (F.when(script == "cyrillic", of(_CYRILLIC, ("на", "н", "нко"))).when(script == "greek", of(_GREEK, ("νη", "νος", "κης")))
            .otherwise(of(_LATIN, ("na", "nus", "ner"))))


def _candidate(key: str, attempt: int) -> Column:
    """The surrogate of an entity row at one attempt."""
    kind, canonical = F.col("kind"), F.col("canonical")
    hashed = F.sha2(F.concat_ws("\n", F.lit(key), kind, canonical, F.col("gender"), F.lit(str(attempt))), 512)
    by_domain = F.sha2(F.concat_ws("\n", F.lit(key), F.lit("domain"), F.substring_index(canonical, "@", -1)), 512)
    # The local part keeps its shape and grows when its shape is used up; the
    # domain keeps its labels' shapes under a name that no one can register.
    local, domain = F.substring_index(canonical, "@", 1), F.substring_index(canonical, "@", -1)
    longer = F.substr(hashed, F.lit(1), F.lit(attempt)) if attempt else F.lit("")
    labels = F.regexp_replace(domain, r"\.[^.]*$", "")
    email = F.concat(_shaped(local, hashed, F.lit(0)), longer, F.lit("@"),
                     _shaped(F.when(F.length(labels) < 3, F.lit("mail")).otherwise(labels), by_domain, F.lit(0)),
                     F.lit(".example"))
    # 240/4 is reserved: no address there is anyone's.
    ip = F.concat_ws(".", (_byte(hashed, F.lit(0)) % 15 + 240).cast("string"),
                     *(_byte(hashed, F.lit(i)).cast("string") for i in (1, 2, 3)))
    card = _shaped(canonical, hashed, F.lit(1))
    body = F.substr(card, F.lit(1), F.length(card) - 1)
    check = (F.lit(10) - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(_luhn(canonical) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(card)
    ssn = F.concat(F.lit("9"), F.substr(_shaped(canonical, hashed, F.lit(0)), F.lit(2), F.lit(8)))  # never issued
    name = _spelled(hashed, F.col("script"), F.col("gender"), F.lit(3 + attempt // 4))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "ssn", ssn)
            .when(kind.isin("given", "surname"), name)
            .when(kind == "iban", _shaped(canonical, hashed, F.lit(2))).otherwise(_shaped(canonical, hashed, F.lit(1))))


def surrogates(entities: DataFrame, *, key: str, stalled: int = STALLED) -> DataFrame:
    """Rows (kind, canonical, gender, surrogate) for distinct entities (kind,
    canonical, gender, script). Surrogates of a kind are distinct and none is a
    canonical form of that kind. Each attempt is one aggregation and two joins
    over the entities still without one, until all have one; if ``stalled``
    attempts in a row give none, their shape has no values left, an error."""
    attempt, idle, left = -1, 0, None
    names = ("kind", "canonical", "gender", "script")
    real = entities.select(F.col("kind").alias("r_kind"), F.col("canonical").alias("r_value")).distinct()
    done, pending = None, entities
    while idle < stalled:
        attempt += 1
        drawn = pending.withColumn("surrogate", _candidate(key, attempt))
        order = F.struct(F.xxhash64("canonical", "gender"), "canonical", "gender")
        # Of entities that draw the same, one keeps it.
        first = drawn.groupBy(F.col("kind").alias("f_kind"), F.col("surrogate").alias("f_value")).agg(
            F.min(order).alias("first"))
        drawn = drawn.join(first, (F.col("kind") == F.col("f_kind")) & (F.col("surrogate") == F.col("f_value")))
        drawn = drawn.withColumn("wins", F.struct(F.xxhash64("canonical", "gender"), "canonical", "gender") == F.col("first"))
        taken = real if done is None else real.unionByName(
            done.select(F.col("kind").alias("r_kind"), F.col("surrogate").alias("r_value")))
        drawn = common.durable(
            drawn.join(taken.withColumn("taken", F.lit(True)),
                       (F.col("kind") == F.col("r_kind")) & (F.col("surrogate") == F.col("r_value")), "left")
            .select(*names, "surrogate", (F.col("wins") & F.col("taken").isNull()).alias("kept")))
        accepted = drawn.filter("kept").select(*names, "surrogate")
        done = accepted if done is None else done.unionByName(accepted)
        pending = drawn.filter("not kept").select(*names)
        before, left = left, pending.count()
        if not left:
            return done
        idle = idle + 1 if left == before else 0
    raise RuntimeError(f"{left} entities have no distinct surrogate: the last {stalled} of {attempt + 1} attempts gave none")


# ---- texts -------------------------------------------------------------------

def _rendered(mention: Column, found: Column) -> Column:
    """A mention in its own format, from the surrogates of its parts."""
    kind, parts = _kind_of(mention), _parts(mention)
    value = lambda part: F.element_at(found, _entity_key(part))
    one = value(parts[0])
    characters = F.filter(F.split(mention, ""), lambda c: c != "")
    # The n-th digit (letter or digit, for an IBAN) of the surrogate goes where
    # the mention has its n-th.
    filled = lambda unit: F.array_join(F.transform(characters, lambda c, i: F.when(
        c.rlike(unit), F.substr(one, F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1),
                                                               unit.replace("[", "[^"), "")), F.lit(1))).otherwise(c)), "")
    cased = lambda word, new: F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(new)).otherwise(F.initcap(new))
    title = F.regexp_extract(mention, f"^{_LEAD}+", 0)
    words = _words(mention)
    name = F.concat(title, F.array_join(F.zip_with(words, parts, lambda w, p: cased(w, value(p))), " "))
    return (F.when(kind == "name", name).when(kind == "email", F.when(mention == F.upper(mention), F.upper(one)).otherwise(one))
            .when(kind == "ip", one).when(kind == "iban", filled("[A-Z0-9]")).otherwise(filled("[0-9]")))


def _words(mention: Column) -> Column:
    """The name parts of a name as they are spelled."""
    return F.split(F.regexp_replace(mention, f"^{_LEAD}+", ""), " ")


def _spellings(mentions: Column) -> Column:
    """How the parts of a text's names may stand alone in it: (spelling, entity
    key). One table serves to find them and to look them up, so that what case
    folding makes of a letter ("ß") cannot be found and then not be known."""
    def of(mention: Column) -> Column:
        return F.flatten(F.zip_with(_words(mention), _parts(mention), lambda word, part: F.transform(
            F.array_distinct(F.array(word, F.upper(word), F.initcap(word))),
            lambda spelled: F.struct(spelled.alias("spelled"), _entity_key(part).alias("entity")))))

    names = F.filter(mentions, lambda m: _kind_of(m) == "name")
    return F.filter(F.array_distinct(F.flatten(F.transform(names, of))), lambda s: F.length(s["spelled"]) > 1)


def _bare_pattern(spellings: Column) -> Column:
    """What finds the spellings where they stand alone; null without names. Names
    hold letters, apostrophes and hyphens, nothing that a pattern reads otherwise."""
    return F.when(F.size(spellings) > 0, F.concat(
        F.lit(r"(?<!\p{L})(?:"), F.array_join(F.array_distinct(F.transform(spellings, lambda s: s["spelled"])), "|"),
        F.lit(r")(?!\p{L})")))


def _without_bare_names(gap: Column, pattern: Column, spellings: Column, found: Column) -> Column:
    """The text between mentions, with surrogates for the name parts that stand alone in it."""
    bare, rest = F.regexp_extract_all(gap, pattern, F.lit(0)), F.split(gap, pattern, -1)

    def written(word: Column, after: Column) -> Column:
        entity = F.get(F.filter(spellings, lambda s: s["spelled"] == word), F.lit(0))["entity"]
        new = F.coalesce(F.element_at(found, entity), word)
        return F.concat(F.when(word == F.upper(word), F.upper(new)).otherwise(F.initcap(new)), after)

    replaced = F.concat(F.element_at(rest, 1), F.array_join(F.zip_with(bare, F.slice(rest, 2, F.size(bare)), written), ""))
    return F.when(pattern.isNotNull() & gap.rlike(r"\p{Lu}"), replaced).otherwise(gap)


def _with_mentions(docs: DataFrame, text: str, name: str) -> DataFrame:
    whole = common.whole(text)
    return docs.withColumn(name, F.when(whole.rlike(HINT), F.regexp_extract_all(whole, F.lit(ANY), 0))
                           .otherwise(F.array().cast("array<string>")))


def replace_personal_data(docs: DataFrame, *, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text`` and a column of counts by kind,
    ``pii_counts`` (a map, empty where nothing was found). Parts of a text's names
    that stand alone in it get their surrogates too, and are not counted.

    ``key`` is the caller's secret: who has it can find out which surrogate stands
    for a guessed entity. The same entity has the same surrogate in every text and
    for every run with the same key over the same corpus. A null text stays null; empty texts,
    repeated rows and ids need no care, since rows are taken one by one; all
    other columns are passed on."""
    mentions, hashed, parts, found, h_name, names, bare = (common.unused_name(docs, n) for n in (
        "mentions", "hash", "parts", "surrogates", "text_hash", "names", "bare"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = _with_mentions(docs, text, mentions)
    some = rows.filter(F.size(mentions) > 0).withColumn(hashed, F.xxhash64(text))
    asked = common.durable(
        some.select(F.col(hashed).alias("h"), F.explode(F.array_distinct(mentions)).alias("mention"))
        .select("h", F.explode(_parts(F.col("mention"))).alias("part")).select("h", "part.*").distinct())
    drawn = surrogates(asked.select("kind", "canonical", "gender", "script")
                       .groupBy("kind", "canonical", "gender").agg(F.min("script").alias("script")), key=key)
    drawn = drawn.select(*(F.col(c).alias(f"s_{c}") for c in ("kind", "canonical", "gender")), "surrogate")
    same = [F.col(c) == F.col(f"s_{c}") for c in ("kind", "canonical", "gender")]
    maps = (asked.select("h", "kind", "canonical", "gender").join(drawn, reduce(lambda a, b: a & b, same))
            .groupBy(F.col("h").alias(h_name))
            .agg(F.map_from_entries(F.collect_set(F.struct(
                F.concat_ws("|", "kind", "canonical", "gender"), "surrogate"))).alias(found)))
    counts = F.transform(F.array(*map(F.lit, KINDS)), lambda kind: F.struct(
        kind, F.size(F.filter(F.col(mentions), lambda m: _kind_of(m) == kind))))
    counts = F.map_from_entries(F.filter(counts, lambda e: e["col2"] > 0))
    asking = some.withColumn(names, _spellings(F.col(mentions))).withColumn(bare, _bare_pattern(F.col(names)))
    gaps = F.transform(F.split(text, ANY, -1), lambda gap: _without_bare_names(
        gap, F.col(bare), F.col(names), F.col(found)))
    written = F.concat(F.element_at(gaps, 1), F.array_join(F.zip_with(
        F.col(mentions), F.slice(gaps, 2, F.size(mentions)), lambda m, gap: F.concat(_rendered(m, F.col(found)), gap)), ""))
    replaced = asking.join(maps, F.col(hashed) == F.col(h_name)).withColumn(parts, counts).withColumn(text, written)
    untouched = rows.filter(F.size(mentions) == 0)
    nothing = F.create_map().cast("map<string,int>")
    return untouched.select(*columns, nothing.alias("pii_counts")).unionByName(
        replaced.select(*columns, F.col(parts).alias("pii_counts")))
