"""Column helpers for texts and names. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and line ends as Unicode has them, and the words that name a file's role.
WHITE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WHITE_CHARS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
QUESTION_WORDS = ("question", "questions", "ques", "qn", "qns", "q", "paper", "papers")
ANSWER_WORDS = ("answer", "answers", "ans", "solution", "solutions", "sol", "soln", "sols", "explanation", "explanations", "explaination", "explainations", "key", "keys")
STOPWORDS = ("that", "this", "with", "from", "have", "will", "shall", "which", "there", "their", "about", "into", "such", "than", "then", "when")
MIN_CHARS, MIN_ALNUM, MIN_PRINTABLE, MAX_WEIRD = 40, 0.55, 0.85, 0.02


def strip(text: Column) -> Column:
    """Without white space at both ends, Unicode white space included."""
    return F.btrim(text, F.lit(WHITE_CHARS))


def lines(text: Column) -> Column:
    """Lines of a text, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text, LINE_END), strip), lambda x: x != "")


def tokens(name: Column) -> Column:
    """Lower-case runs of Latin letters and digits."""
    return F.filter(F.split(F.lower(name), "[^a-z0-9]+"), lambda t: t != "")


def role(name: Column) -> Column:
    """answer where an answer word occurs, else question where a question word does, else unmarked."""
    words = tokens(name)
    answer = F.arrays_overlap(words, F.array(*map(F.lit, ANSWER_WORDS)))
    question = F.arrays_overlap(words, F.array(*map(F.lit, QUESTION_WORDS)))
    return F.when(answer, "answer").when(question, "question").otherwise("unmarked")


def signature(name: Column) -> Column:
    """The name's tokens without role words; repeated tokens stay."""
    return F.array_join(F.filter(tokens(name), lambda t: ~t.isin(*QUESTION_WORDS, *ANSWER_WORDS)), " ")


def loose_signature(name: Column) -> Column:
    return F.replace(signature(name), F.lit(" "), F.lit(""))


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Lower-case extension with its dot; (no extension) where there is none."""
    found = F.lower(F.regexp_extract(base_name(path), r".(\.[^.]+)$", 1))
    return F.when(found == "", "(no extension)").otherwise(found)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def share_of(text: Column, pattern: str) -> Column:
    """Part of a text's characters that match a pattern for one of them."""
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def alnum_ratio(text: Column) -> Column:
    """Letters and digits, taken out by runs, which is far cheaper than to count them one by one."""
    return (F.length(text) - F.length(F.regexp_replace(text, r"[\p{L}\p{N}]+", ""))) / F.greatest(F.length(text), F.lit(1))


def printable_ratio(text: Column) -> Column:
    """What is left when controls and separators but space, line end and tab are counted out."""
    return (F.length(text) - F.regexp_count(text, F.lit(r"[\p{C}\p{Z}&&[^ \n\t]]"))) / F.greatest(F.length(text), F.lit(1))


def weird_ratio(text: Column) -> Column:
    return share_of(text, r"[\x{fffd}\x00-\x08\x0b\x0c\x0e-\x1f]")


def quality(text: Column) -> Column:
    """EMPTY, GARBLED or CLEAN of a page's text; null counts as empty."""
    t = strip(F.coalesce(text, F.lit("")))
    garbled = (printable_ratio(t) < MIN_PRINTABLE) | (weird_ratio(t) > MAX_WEIRD) | (alnum_ratio(t) < MIN_ALNUM)
    return F.when(F.length(t) < MIN_CHARS, "EMPTY").when(garbled, "GARBLED").otherwise("CLEAN")


def word_set(text: Column) -> Column:
    """Distinct lower-case words of four or more Latin letters."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{4,}"), F.lit(0)))


def grounding(claim: Column, context: Column) -> Column:
    """Part of the claim's words (without stopwords) that the context has; 0 where it has none."""
    words = F.array_except(word_set(F.coalesce(claim, F.lit(""))), F.array(*map(F.lit, STOPWORDS)))
    return F.when(F.size(words) == 0, 0.0).otherwise(F.size(F.array_intersect(words, word_set(F.coalesce(context, F.lit(""))))) / F.size(words))


def human_size(count: Column) -> Column:
    """Bytes with a unit."""
    out, value = None, count.cast("double")
    for power, unit in enumerate(("B", "KB", "MB", "GB", "TB")):
        shown = F.format_string(f"%.1f {unit}", value / 1024**power)
        fits = value < 1024 ** (power + 1)
        out = F.when(fits, shown) if out is None else out.when(fits, shown)
    return out.otherwise(F.format_string("%.1f PB", value / 1024**5))


def page_label(start: Column, end: Column) -> Column:
    """p3 or p3-5."""
    return F.when(start.eqNullSafe(end), F.format_string("p%d", start)).otherwise(F.format_string("p%d-%d", start, end))
