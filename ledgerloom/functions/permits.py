"""Rows and fields out of the text of permit pages: status, contractors, names, fees and inspections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profiles import let
from .text import collapse, integer, lenient_date, name_key, number, string

#: Words that mark a company when among the first three of a name.
COMPANY_WORDS = ["AIR", "BUILDERS", "BUILDING", "CO", "COMPANY", "CONSTRUCTION", "CONTRACTING", "CONTRACTOR", "CORP", "CORPORATION", "DESIGNS", "ELECTRIC", "ELECTRICAL", "HEATING", "INC", "LLC", "LTD", "SERVICES", "SERVICE", "SIGN", "SIGNS"]
#: Suffixes of persons.
PERSON_SUFFIXES = ["JR", "SR", "II", "III", "IV", "V"]
#: Kinds of licences.
LICENCES = ["Certified General Cntr", "General Contractor", "Certified Electrical Cntr", "Certified Electrical Cont", "Certified Outdoor Sign Spec", "Sign Erection Electrical", "Sign Contr-Limited", "Air Cond & Heating Class A", "Air Cond & Heating Class B", "Building Contractor", "Cement Mason", "Master Electrician"]
#: Page labels that follow a status without a boundary of its own.
AFTER_STATUS = ["Click here for more information", "Create a New Collection", "Add to Existing Collection", "Record Info", "Record Details", "Processing Status", "Related Records", "Work Location"]
#: Headings of fee lists and what they say of the fees below, the stronger ones first.
FEE_HEADINGS = [("paid / discounted", "PAID_OR_DISCOUNTED"), ("paid fees", "PAID_OR_DISCOUNTED"), ("outstanding", "OUTSTANDING")]
#: Fixed value: how many characters before a fee its heading may stand.
HEADING_REACH = 240
#: Results of inspections, longer ones first.
RESULTS = ["Partial Pass", "Pass", "Fail", "Cancelled", "Canceled"]
#: What may precede an event of a processing history.
EVENT_KINDS = ["Marked as", "Assigned to", "Due on"]
#: Labels of telephone numbers, and names of the state in addresses.
PHONE_LABELS = ["Primary Phone:", "Alternate Phone:", "Fax:"]
STATES = ["FL", "FLORIDA"]
STATUS_WIDTH = 256


def status(c: Column) -> Column:
    """A record's status up to the first page label, cut to its column's width; null if blank."""
    labels = "|".join(AFTER_STATUS)
    text = F.regexp_replace(F.regexp_replace(string(c), r"(?U)\s+", " "), rf"(?is)\s+(?:{labels})\b.*$", "")
    return F.nullif(F.rtrim(F.substring(F.trim(text), 1, STATUS_WIDTH)), F.lit(""))


def _words(c: Column) -> Column:
    return F.filter(F.split(collapse(c), " "), lambda w: w != "")


def _first(items: Column, test) -> Column:
    """Place (from 0) of the first item for which test(item, place) holds; null without one."""
    return F.get(F.filter(F.transform(items, lambda x, i: F.when(F.coalesce(test(x, i), F.lit(False)), i)), lambda i: i.isNotNull()), F.lit(0))


def _is_day(word: Column) -> Column:
    """Whether a word is a date with slashes, as pages write it."""
    parts = F.split(word, "/")
    return (F.size(parts) == 3) & F.forall(parts, lambda p: (p != "") & (F.translate(p, "0123456789", "") == "")) & F.length(F.get(parts, F.lit(2))).eqNullSafe(F.lit(4))


def _is_phrase(words: Column, at: Column, phrase: str) -> Column:
    """Whether words from place `at` on are the phrase, in any case; its first word is looked at before others are joined."""
    first, *more = phrase.lower().split(" ")
    head = F.lower(F.get(words, at)) == first
    return head & (F.lower(F.array_join(F.slice(words, at + 1, len(more) + 1), " ")) == phrase.lower()) if more else head


def _starts_phrase(words: Column, at: Column, phrases: list[str]) -> Column:
    """Whether the word at place `at` is the first one of a phrase."""
    return F.lower(F.get(words, at)).isin(*sorted({p.lower().split(" ")[0] for p in phrases}))


def _tokens(c: Column) -> Column:
    return F.filter(F.split(collapse(F.regexp_replace(c, r"[.,]", " ")), " "), lambda t: t != "")


def _phrase(tokens: Column) -> Column:
    return F.nullif(F.array_join(tokens, " "), F.lit(""))


def contractor(c: Column) -> Column:
    """struct(person, company): all company if one of the first three words says so, else leading words of a person."""
    return let(_tokens(c), _contractor)


def _contractor(t: Column) -> Column:
    is_company = F.exists(F.slice(t, 1, 3), lambda w: F.upper(w).isin(*COMPANY_WORDS))
    named = F.when(F.length(F.get(t, F.lit(1))) == 1, 3).otherwise(2)
    named = F.when(F.upper(F.get(t, named)).isin(*PERSON_SUFFIXES), named + 1).otherwise(named)
    size = F.when(is_company, 0).when(F.size(t) <= 2, F.size(t)).otherwise(F.least(named, F.size(t)))
    return let(size, lambda n: F.struct(_phrase(F.slice(t, F.lit(1), n)).alias("person"), _phrase(F.slice(t, n + 1, F.greatest(F.size(t) - n, F.lit(0)))).alias("company")))


def person_name(c: Column) -> Column:
    """struct(first, middle, last, suffix) of a name in natural order."""
    return let(_tokens(c), _person_name)


def _person_name(all_: Column) -> Column:
    last_word = F.get(all_, F.size(all_) - 1)
    suffix = F.when(F.upper(last_word).isin(*PERSON_SUFFIXES), last_word)
    bare = F.when(suffix.isNull(), all_).otherwise(F.slice(all_, F.lit(1), F.greatest(F.size(all_) - 1, F.lit(0))))
    return let(bare, lambda t: F.struct(
        F.get(t, F.lit(0)).alias("first"), F.when(F.size(t) > 2, F.array_join(F.slice(t, F.lit(2), F.greatest(F.size(t) - 2, F.lit(0))), " ")).alias("middle"), F.when(F.size(t) > 1, F.get(t, F.size(t) - 1)).alias("last"), suffix.alias("suffix")
    ))


def canonical_company(c: Column) -> Column:
    """Name key with U S as US and without AND."""
    return collapse(F.regexp_replace(F.regexp_replace(name_key(c), r"\bU S\b", "US"), r"\bAND\b", " "))


def licence(c: Column) -> Column:
    """struct(kind, number, before) of the last kind of licence with a number after it; null without one.

    A number is a word with a digit, or a few letters and the word after them. Kinds and numbers come as the text has them.
    """

    def numbered_at(words: Column, at: Column) -> Column:
        word, after = F.get(words, at), F.get(words, at + 1)
        letters = (F.length(word) <= 5) & (F.translate(F.upper(word), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "") == "")
        own = F.translate(word, "0123456789", "") != word
        own = own & (F.translate(F.upper(word), "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-", "") == "") & ((F.length(word) >= 3) | (F.translate(F.substring(word, 1, 1), "0123456789", "") != ""))
        return F.when(own, word).when(letters & (F.translate(after, "0123456789-", "") == ""), F.concat_ws(" ", word, after))

    def read(words: Column) -> Column:
        def hit(i: Column) -> Column:
            found = [F.when(_is_phrase(words, i, kind), F.struct(i.alias("at"), F.array_join(F.slice(words, i + 1, n), " ").alias("kind"), numbered_at(words, i + n).alias("number"))) for kind in LICENCES for n in [len(kind.split(" "))]]
            return F.when(_starts_phrase(words, i, LICENCES), F.coalesce(*found))

        hits = F.filter(F.transform(words, lambda _, i: hit(i)), lambda h: h["number"].isNotNull())
        return let(F.get(F.reverse(hits), F.lit(0)), lambda last: F.when(last.isNotNull(), F.struct(last["kind"].alias("kind"), last["number"].alias("number"), F.array_join(F.slice(words, F.lit(1), last["at"]), " ").alias("before"))))

    return let(_words(c), read)


def without_phones(c: Column) -> Column:
    """A text without labelled telephone numbers: each label goes, and the words of digits and brackets after it."""
    mark = "\x01"
    text = c
    for label in PHONE_LABELS:
        text = F.regexp_replace(text, rf"(?i)\b{label}", f" {mark} ")

    def step(state: Column, word: Column) -> Column:
        label, number_ = word == mark, F.translate(word, "0123456789().-", "") == ""
        return F.struct(F.when(label | (state["skips"] & number_), state["kept"]).otherwise(F.concat(state["kept"], F.array(word))).alias("kept"), (label | (state["skips"] & number_)).alias("skips"))

    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("skips"))
    return F.aggregate(_words(text), start, step, lambda state: F.array_join(state["kept"], " "))


def split_address(c: Column) -> Column:
    """struct(prefix, address): the address starts at a house number or box and ends with the ZIP behind a state that a
    comma precedes; without such an end all is prefix."""

    def read(words: Column) -> Column:
        zip_ = lambda w: F.regexp_extract(w, r"^\d{5}(?:-\d{4})?", 0)

        def ends(w: Column, i: Column) -> Column:
            state, before = F.get(words, i - 1), F.get(words, i - 2)
            own = F.rtrim(F.translate(state, ",", " "))
            last = F.upper(F.element_at(F.split(own, " "), -1))
            return (zip_(w) != "") & last.isin(*STATES) & (F.contains(own, F.lit(" ")) | F.endswith(before, F.lit(",")))

        def starts(w: Column, i: Column) -> Column:
            box = F.translate(F.upper(w), ".", "").eqNullSafe(F.lit("PO")) & F.upper(F.rtrim(F.translate(F.get(words, i + 1), ",", " "))).eqNullSafe(F.lit("BOX"))
            return ((F.length(w) <= 6) & (F.translate(w, "0123456789", "") == "")) | box

        end = _first(words, lambda w, i: F.when(i >= 2, ends(w, i)))
        start = _first(words, starts)
        return let(F.struct(start.alias("start"), end.alias("end")), lambda p: F.when(
            p["start"] < p["end"] - 1,
            F.struct(F.array_join(F.slice(words, F.lit(1), p["start"]), " ").alias("prefix"), F.concat_ws(" ", F.array_join(F.slice(words, p["start"] + 1, p["end"] - p["start"]), " "), zip_(F.get(words, p["end"]))).alias("address")),
        ).otherwise(F.struct(F.array_join(words, " ").alias("prefix"), F.lit(None).cast("string").alias("address"))))

    return F.when(c.isNull(), F.struct(F.lit(None).cast("string").alias("prefix"), F.lit(None).cast("string").alias("address"))).otherwise(let(_words(c), read))


def numbered(c: Column) -> Column:
    """Blocks of a text in the form 1) .. 2) .., without their numbers."""
    pieces = F.split(c, r"(?:^|\s)\d+\)\s")
    return F.filter(F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), F.trim), lambda b: b != "")


def fees(c: Column) -> Column:
    """array<struct(paid_on, invoice, amount, status)>: the status is the strongest heading shortly before a row.

    A row is what stands before "View Details": a day, an invoice and an amount, each a word.
    """
    pieces = F.split(c, r"(?i)\bview\s+details")

    def read(piece: Column) -> Column:
        def of(words: Column) -> Column:
            day, invoice, amount = (F.get(words, F.size(words) - k) for k in (3, 2, 1))
            ok = F.coalesce(_is_day(day) & (F.translate(F.upper(invoice), "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-", "") == ""), F.lit(False))
            fee = lambda value: F.when(value.isNotNull(), F.struct(lenient_date(day).alias("paid_on"), invoice.alias("invoice"), value.alias("amount"), F.length(F.concat_ws(" ", day, invoice, amount)).alias("width")))
            return F.when(ok, let(number(amount), fee))

        return F.struct(piece.alias("text"), let(_words(piece), of).alias("fee"))

    def step(state: Column, part: Column) -> Column:
        fee = part["fee"]
        seen = F.right(F.concat(state["seen"], part["text"]), F.coalesce(fee["width"], F.lit(0)) + HEADING_REACH)
        near = F.lower(F.substring(seen, F.lit(1), F.length(seen) - F.coalesce(fee["width"], F.lit(0))))
        kind = F.coalesce(*[F.when(F.contains(near, F.lit(h)), F.lit(status_)) for h, status_ in FEE_HEADINGS], F.lit("UNKNOWN"))
        one = F.struct(fee["paid_on"].alias("paid_on"), fee["invoice"].alias("invoice"), fee["amount"].alias("amount"), kind.alias("status"))
        return F.struct(F.concat(seen, F.lit(" View Details")).alias("seen"), F.when(fee.isNull(), state["rows"]).otherwise(F.concat(state["rows"], F.array(one))).alias("rows"))

    parts = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), read)  # the last piece precedes no row
    empty = F.array().cast("array<struct<paid_on:string,invoice:string,amount:double,status:string>>")
    return F.when(c.isNotNull(), F.aggregate(parts, F.struct(F.lit("").alias("seen"), empty.alias("rows")), step, lambda s: s["rows"]))


def fee_total(amounts: Column) -> Column:
    """Sum of the amounts to two decimals; null when there are none."""
    known = F.filter(amounts, lambda a: a.isNotNull())
    return F.when(F.size(known) > 0, F.round(F.aggregate(known, F.lit(0.0), lambda a, b: a + b), 2))


def events(c: Column) -> Column:
    """array<struct(kind, status, day, actor)> of a processing history, one event a line: kind, status, "on" a day "by" whom."""

    def read(line: Column) -> Column:
        def of(words: Column) -> Column:
            kind = lambda i: F.when(_starts_phrase(words, i, EVENT_KINDS), F.coalesce(*[F.when(_is_phrase(words, i, k), F.lit(k)) for k in EVENT_KINDS]))
            end = lambda start: _first(words, lambda w, i: (i > start + 2) & (F.lower(w) == "on") & _is_day(F.get(words, i + 1)) & (F.lower(F.get(words, i + 2)) == "by") & (F.size(words) > i + 3))
            return let(let(_first(words, lambda _, i: kind(i).isNotNull()), lambda start: F.struct(start.alias("start"), end(start).alias("end"))), lambda p: F.when(p["end"].isNotNull(), F.struct(
                F.replace(F.upper(kind(p["start"])), F.lit(" "), F.lit("_")).alias("kind"), F.array_join(F.slice(words, p["start"] + 3, p["end"] - p["start"] - 2), " ").alias("status"),
                lenient_date(F.get(words, p["end"] + 1)).alias("day"), F.array_join(F.slice(words, p["end"] + 4, F.size(words)), " ").alias("actor"),
            )))

        return let(_words(line), of)

    return F.filter(F.transform(F.split(c, "\n"), read), lambda e: e.isNotNull())


def inspections(c: Column) -> Column:
    """array<struct(result, code, type, identifier, inspector, day)> of the section of completed inspections.

    The section goes on to "Digital Projects", or else to the end of the text, however long it is. It is cut at "Result
    by:": to the left of a cut stand the result, code, type and number in brackets, to the right the inspector, "on" and
    the day, and then the next row.
    """
    start = F.position(F.lit("Completed ("), c)
    section = F.when(start > 0, F.substring_index(F.substring(c, start, F.length(c)), "Digital Projects", 1)).otherwise(F.lit(""))
    pieces = F.transform(F.split(section, r"(?i)result\s+by:"), _words)

    def left(words: Column) -> Column:
        own_ = F.slice(words, F.lit(1), F.size(words) - 1)
        number_ = F.regexp_extract(F.get(words, F.size(words) - 1), r"^\((\d+)\)$", 1)
        return F.when(number_ != "", let(own_, lambda own: let(bracket_of(own), lambda bracket: result_of(own, bracket, number_))))

    def bracket_of(own: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(own, lambda w, i: F.when(F.contains(w, F.lit("(")) | F.contains(w, F.lit(")")), i))), F.lit(-1))

    def result_of(own: Column, bracket: Column, number_: Column) -> Column:
        result = lambda i: F.when(_starts_phrase(own, i, RESULTS), F.coalesce(*[F.when(_is_phrase(own, i, r), F.lit(len(r.split(" ")))) for r in RESULTS]))
        at = _first(own, lambda _, i: (i > bracket) & (i + result(i) + 1 < F.size(own)))
        return let(at, lambda i: F.when(i.isNotNull(), F.struct(
            F.array_join(F.slice(own, i + 1, result(i)), " ").alias("result"), F.get(own, i + result(i)).alias("code"), F.array_join(F.slice(own, i + result(i) + 2, F.size(own)), " ").alias("type"), number_.alias("identifier"),
        )))

    def right(words: Column) -> Column:
        at = _first(words, lambda w, i: (i > 0) & (F.lower(w) == "on") & _is_day(F.get(words, i + 1)))
        return let(at, lambda i: F.struct(F.array_join(F.slice(words, F.lit(1), i), " ").alias("inspector"), F.get(words, i + 1).alias("day"), F.slice(words, i + 3, F.size(words)).alias("rest")))

    def rows(ps: Column) -> Column:
        sides = F.transform(ps, lambda w, i: let(right(w), lambda r: F.struct(F.when(i == 0, w).otherwise(F.coalesce(r["rest"], w)).alias("left"), r.alias("right"))))
        return let(sides, lambda ss: F.transform(F.slice(ss, F.lit(1), F.size(ss) - 1), lambda s, i: let(F.struct(left(s["left"]).alias("a"), F.get(ss, i + 1)["right"].alias("b")), lambda x: F.when(
            x["a"].isNotNull() & x["b"]["day"].isNotNull(), F.struct(*[x["a"][n].alias(n) for n in ("result", "code", "type", "identifier")], *[x["b"][n].alias(n) for n in ("inspector", "day")]))
        )))

    return F.filter(let(pieces, rows), lambda r: r.isNotNull())


def banner(c: Column) -> Column:
    """struct(first, last, total) of Showing a-b of N."""
    p = r"(?i)Showing\s+([\d,]+)\s*-\s*([\d,]+)\s+of\s+([\d,]+)"
    return F.struct(*[integer(F.regexp_extract(c, p, i)).alias(n) for i, n in ((1, "first"), (2, "last"), (3, "total"))])
