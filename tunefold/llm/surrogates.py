"""Keyed surrogates for personal data, with DataFrame functions only (operator 2).

Detected: e-mail addresses, IPv4 addresses (no numbers of a version or release), phone
numbers, card numbers (in fours, bare ones of 16 digits, or bare ones of other lengths with a right
check digit that are no book numbers), social security numbers, bank accounts (IBAN), access keys
and signed tokens, hexadecimal secrets, and persons named after a title.

* A mention is reduced to its canonical form (digits of a phone, lower case of an
  address, each word of a name), so all its spellings get one surrogate
  (coreference), written in the spelling's own format.
* The surrogate is a keyed function (SHA-256 of key, kind, attempt, canonical form
  and place) that maps digits to digits and letters to letters of the same case
  and script, keeps signs and length, and keeps what makes the type: country code
  of a phone, first digit and Luhn validity of a card, key prefixes, hexadecimal
  letters, domain form. Given names come from a list of the title's gender and
  script, surnames are spelled in the script.
* Collision checks over the whole table of canonical forms: where two forms of a
  kind meet in one surrogate, all but the least take the next attempt, and so
  does any whose surrogate is itself a form that occurs. That is repeated until
  there is none (from the third attempt on, surrogates of addresses, phones and names grow
  by letters or digits, from the ``LONGER``-th the others do too, at the cost of their format,
  so there is always room). So different entities stay different, and no surrogate
  is somebody's real datum.

At scale: texts are searched where they lie. Only texts with mentions, and the
mentions, are shuffled; the table of mentions is pre-aggregated, so a mention that
stands in a third of all rows is one row there, and the join that brings
surrogates to texts is one that AQE splits. Nothing is collected but counts.

Rows: null and empty texts stay; null and repeated doc_ids and repeated rows stay
row by row; extra columns are kept; ``n_chars``, if there, is set to the new
length of changed texts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefold.llm.common import fresh, written

# What is looked for, in order of precedence.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_MALE = r"(?:Mr|Herr|Señor|Monsieur|Signor|Mister|г-н|господин|κύριος)"
_FEMALE = r"(?:Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mademoiselle|Signora|г-жа|госпожа|κυρία)"
KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.])(?<!ersion )(?<!elease ){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:ghp_|sk-)[A-Za-z0-9]{20,}\b"
    r"|\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "hex": r"\b(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,64}\b"
    r"|\b(?=[0-9A-F]*[A-F])(?=[0-9A-F]*[0-9])[0-9A-F]{32,64}\b",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])|(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
    r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z.,+-])(?<![0-9] )0[1-9][0-9]{1,3} [0-9]{3,4} [0-9]{3,4}(?! ?[0-9])",
    "man": rf"(?<![\p{{L}}]){_MALE}\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
    "woman": rf"(?<![\p{{L}}]){_FEMALE}\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
}
PATTERN = "|".join(KINDS.values())
#: A bare number of such a length is a card's if its check digit is right (of 16 digits, any), and no book number.
_BARE, _BOOK = "^(?:[0-9]{13,15}|[0-9]{17,19})$", "^97[89][0-9]{10}$"
#: The attempt from which surrogates of kinds of fixed length grow as well.
LONGER, FIXED = 20, ("ip", "ssn", "card", "hex", "key", "iban")
#: A text without any of these can't hold a mention; the test is much cheaper than the search.
_HINT = rf"[0-9@]|(?:AKIA|ASIA)[A-Z]{{16}}|(?:ghp_|sk-)[A-Za-z]{{20}}|eyJ|{_MALE}|{_FEMALE}"
# Given names by script and gender, syllables of surnames by script, letters by script.
GIVEN = {
    ("latin", "man"): "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Noah Oscar Paul".split(),
    ("latin", "woman"): "Anna Berta Clara Diana Elena Flora Greta Helena Iris Julia Katia Laura Marta Nora Olga Paula".split(),
    ("cyrillic", "man"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Юрий".split(),
    ("cyrillic", "woman"): "Анна Вера Галина Дарья Елена Жанна Ирина Ксения Лидия Мария Нина Ольга Полина Рита София Юлия".split(),
    ("greek", "man"): "Ανδρέας Γιώργος Δημήτρης Ηλίας Κώστας Λουκάς Μάριος Νίκος Πέτρος Στέφανος".split(),
    ("greek", "woman"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ιωάννα Κατερίνα Μαρία Νίκη Σοφία".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke ko la le li lo ma me mi mo na ne no ra re ri ro sa ta vo".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до за ка ке ко ла ле ли ло ма ме ми мо на не но ра ре ри ро са та".split(),
    "greek": "βα βε βο γα γο δα δε δο κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε πο ρα ρε ρι ρο σα τα το".split(),
}


def _number(*parts) -> Column:
    """A keyed number from 0 to 2**32 - 1."""
    text = F.concat_ws("|", *(p if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def _pick(options: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (number % len(options) + 1).cast("int"))


def _kind(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    number = mention.rlike(_BARE) & (mention.rlike(_BOOK) | ~F.call_function("luhn_check", F.when(mention.rlike(_BARE), mention).otherwise("0")))
    return F.when(~number, out)


def _script(word: Column) -> Column:
    greek = F.when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise(greek)


def _digits(kind: Column, text: Column) -> Column:
    """The digits of a number; those of a phone without the country code 1 that some spellings lack."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when((kind == "phone") & digits.rlike("^1[0-9]{10}$"), F.substring(digits, 2, 10)).otherwise(digits)


def _forms(kind: Column, mention: Column) -> Column:
    """(kind, canonical form) pairs of a mention; a name has one for each word."""
    words = F.split(F.regexp_replace(mention, r"^\S+ ", ""), " ")
    plain = F.lower(F.regexp_replace(mention, r"[^\p{L}\p{N}@._%+-]", ""))
    digits = _digits(kind, mention)
    one = F.when(kind.isin("phone", "card", "ssn"), digits).when(kind.isin("key", "iban"), F.regexp_replace(mention, " ", "")).otherwise(plain)
    last = F.struct(F.lit("surname").alias("kind"), F.lower(F.element_at(words, -1)).alias("form"))
    first = F.struct(F.concat(F.lit("given "), kind).alias("kind"), F.lower(F.element_at(words, 1)).alias("form"))
    name = F.when(F.size(words) > 1, F.array(first, last)).otherwise(F.array(last))
    return F.when(kind.isin("man", "woman"), name).otherwise(F.array(F.struct(kind.alias("kind"), one.alias("form"))))


def _mapped(text: Column, kind: Column, key: str, attempt: Column, form: Column) -> Column:
    """``text`` with letters and digits replaced by place; signs stay. All spellings of a form agree place by place."""

    def one(c: Column, i: Column) -> Column:
        # counted from the end, as some spellings of a phone lack the country code
        place = F.length(F.regexp_replace(F.substring(text, i + 1, F.length(text)), r"[^\p{L}\p{N}]", ""))
        n = _number(key, kind, attempt.cast("string"), form, place.cast("string"))
        letter = F.char((n % 26 + 97).cast("int"))
        return (
            F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when((kind == "hex") & c.rlike("[a-f]"), F.char((n % 6 + 97).cast("int")))
            .when((kind == "hex") & c.rlike("[A-F]"), F.char((n % 6 + 65).cast("int")))
            .when(c.rlike("[a-z]"), letter)
            .when(c.rlike("[A-Z]"), F.upper(letter))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _surrogate(text: Column, kind: Column, key: str, attempt: Column, form: Column) -> Column:
    """What stands for ``text`` (a spelling of ``form``)."""
    n = _number(key, kind, attempt.cast("string"), form)
    grown = attempt >= 3
    extra = F.when(grown, F.substring(F.sha2(F.concat_ws("|", F.lit(key), form, attempt.cast("string")), 256), 1, 4)).otherwise("")
    mapped = _mapped(text, kind, key, attempt, form)
    tld = F.regexp_extract(text, r"\.([A-Za-z]+)$", 1)
    labels = F.regexp_replace(F.regexp_extract(mapped, "@(.*)$", 1), r"(^|\.)[^.]+\.[^.]+$", "$1")
    email = F.concat(F.regexp_extract(mapped, "^[^@]+", 0), extra, F.lit("@"), labels, F.lit("example."), tld)
    octet = lambda i: (_number(key, "ip", attempt.cast("string"), form, i) % 256).cast("string")
    ip = F.concat_ws(".", (n % 14 + 240).cast("string"), octet(2), octet(3), octet(4))
    country = F.regexp_extract(text, r"^\+[0-9]{1,3}", 0)
    phone = F.concat(country, F.substring(mapped, F.length(country) + 1, F.length(text)), F.regexp_replace(extra, "[a-f]", "7"))
    stem = F.concat(F.substring(text, F.lit(1), F.lit(1)), F.substring(mapped, F.lit(2), F.length(text) - 2))
    sums = F.transform(F.array(*(F.lit(str(d)) for d in range(10))), lambda d: F.concat(stem, d))
    sums_right = lambda x: F.call_function("luhn_check", F.regexp_replace(x, "[^0-9]", ""))
    card = F.element_at(F.filter(sums, lambda x: sums_right(x) == sums_right(text)), 1)
    prefix = F.regexp_extract(text, "^(AKIA|ASIA|ghp_|sk-|eyJ|[A-Z]{2}(?=[0-9]{2}))", 0)
    kept = F.concat(prefix, F.substring(mapped, F.length(prefix) + 1, F.length(text)))
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card)
    out = out.when(kind.isin("key", "iban"), kept)
    script = _script(text)
    for s in SYLLABLES:
        syllable = lambda i, s=s: _pick(SYLLABLES[s], _number(key, kind, attempt.cast("string"), form, f"syllable {i}"))
        more = F.when(grown, F.concat(syllable(5), syllable(6))).otherwise("")
        surname = F.initcap(F.concat(syllable(1), syllable(2), syllable(3), syllable(4), more))
        out = out.when((kind == "surname") & (script == s), surname)
        for g in ("man", "woman"):
            given = F.concat(_pick(GIVEN[s, g], n), F.when(attempt > 0, F.concat(syllable(1), more)).otherwise(""))
            out = out.when((kind == f"given {g}") & (script == s), given)
    out = out.otherwise(mapped)
    tail = F.concat(F.when(kind == "ip", ".").otherwise(""), F.lpad((_number(key, kind, attempt.cast("string"), form, "tail") % 10**6).cast("string"), 6, "0"))
    return F.when(kind.isin(*FIXED) & (attempt >= LONGER), F.concat(out, tail)).otherwise(out)


def _canonical(kind: Column, text: Column) -> Column:
    """The canonical form of a surrogate or a spelling."""
    digits = _digits(kind, text)
    return F.when(kind.isin("phone", "card", "ssn"), digits).when(kind.isin("key", "iban"), F.regexp_replace(text, " ", "")).otherwise(F.lower(text))


def resolved(forms: DataFrame, key: str) -> DataFrame:
    """(kind, form, sample) -> the same with the attempt at which no two surrogates meet and none is a real form."""
    rows = forms.withColumn("attempt", F.lit(0))
    names = ["kind", "form", "sample", "attempt"]
    surrogate = _surrogate(F.col("sample"), F.col("kind"), key, F.col("attempt"), F.col("form"))
    rows = written(rows.withColumn("to", _canonical(F.col("kind"), surrogate)).select(*names, "to"), "pii-forms")
    real = forms.select("kind", F.col("form").alias("to"), F.lit(True).alias("real")).distinct()
    while True:
        first = rows.groupBy("kind", "to").agg(F.min("form").alias("first"), F.count("*").alias("n"))
        first = first.join(real, ["kind", "to"], "left").where("n > 1 or real")
        # the least form keeps a surrogate unless that is real; all others try again
        bad = rows.join(first, ["kind", "to"]).where("real or form <> first").select("kind", "form", F.lit(1).alias("again"))
        bad = written(bad, "pii-collisions")
        if bad.isEmpty():
            return rows.select(*names)
        rows = rows.join(bad, ["kind", "form"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0)))
        to = F.when(F.col("again") == 1, _canonical(F.col("kind"), surrogate)).otherwise(F.col("to"))
        rows = written(rows.withColumn("to", to).select(*names, "to"), "pii-forms")


def replaced(docs: DataFrame, key: str = "surrogate-key-1") -> DataFrame:
    """``docs``, all columns, with every detected mention replaced; ``key`` is the secret that the surrogates hang on."""
    held, digest, made_of = fresh("mentions"), fresh("key"), fresh("to")
    may = F.col("text").isNotNull() & F.col("text").rlike(_HINT)
    mentions = F.regexp_extract_all(F.col("text"), F.lit(PATTERN), F.lit(0))
    found = docs.withColumn(held, F.when(may, mentions)).where(F.size(held) > 0)
    found = written(found.withColumn(digest, F.md5("text")), "pii-texts")
    at = found.dropDuplicates([digest]).select(digest, F.posexplode(held).alias("place", "mention"))
    at = written(at, "pii-mentions")
    spelled = at.select("mention").distinct().withColumn("kind", _kind(F.col("mention"))).where("kind is not null")
    spelled = written(spelled.withColumn("forms", _forms(F.col("kind"), F.col("mention"))), "pii-spellings")
    # a name's words are spelled by themselves; any other mention is its own sample of a spelling
    words = F.split(F.regexp_replace("mention", r"^\S+ ", ""), " ")
    person = F.col("kind").isin("man", "woman")
    samples = F.when(person, F.when(F.size(words) > 1, F.array(F.element_at(words, 1), F.element_at(words, -1))).otherwise(words))
    each = spelled.select("mention", F.explode(F.arrays_zip("forms", F.coalesce(samples, F.array("mention")).alias("samples"))).alias("x"))
    each = each.select("mention", "x.forms.kind", "x.forms.form", F.col("x.samples").alias("sample"))
    attempts = resolved(each.groupBy("kind", "form").agg(F.min("sample").alias("sample")), key).drop("sample")
    made = each.join(attempts, ["kind", "form"])
    made = made.withColumn("to", _surrogate(F.col("sample"), F.col("kind"), key, F.col("attempt"), F.col("form")))
    in_order = F.array_sort(F.collect_list(F.struct((F.col("kind") == "surname").alias("last"), "to")))
    by_mention = made.groupBy("mention").agg(in_order.alias("parts"), F.min("kind").alias("kind"))
    title = F.when(F.col("kind").rlike("^(surname|given .*)$"), F.regexp_extract("mention", r"^\S+ ", 0)).otherwise("")
    by_mention = by_mention.select("mention", F.concat(title, F.array_join(F.col("parts.to"), " ")).alias("to"))
    by_mention = written(by_mention, "pii-surrogates")
    known = at.join(by_mention, "mention", "left").select(digest, "place", F.coalesce("to", "mention").alias("to"))
    lists = known.groupBy(digest).agg(F.array_sort(F.collect_list(F.struct("place", "to"))).alias(made_of))
    pieces = F.split(F.col("text"), PATTERN, -1)
    joined = F.flatten(F.zip_with(pieces, F.col(made_of)["to"], lambda p, s: F.array(p, F.coalesce(s, F.lit("")))))
    changed = found.drop(held).join(lists, digest).withColumn("text", F.array_join(joined, ""))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    rest = docs.where(~F.coalesce(may & F.col("text").rlike(PATTERN), F.lit(False)))
    return changed.select(*docs.columns).unionByName(rest)
