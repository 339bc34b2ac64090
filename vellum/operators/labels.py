"""Dictionary labelling by leftmost-longest matches, and constraints on label lists.

The dictionary's phrases are a trie held as a table of edges (prefix, next word). Places of a text whose word
begins a phrase are found by a join; each then walks down the trie, a word a round, and takes along only
as many words as its longest phrase needs. Phrases have any length, and what begins none is never shuffled with its words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.storage import forget, materialize

#: Characters that part words besides white space, where the corpus doesn't tell others.
BOUNDARIES = "!(),.:;?[]{}"


def annotations(df: DataFrame, order: str, ngram: str = "ngram", prefix: str = "label") -> DataFrame:
    """ngram (lower case), labels: the non-null label columns; rows without a label go, of equal n-grams the last by ``order`` stays.

    A table has no order of its own once it is dealt to tasks, so the column that holds it is needed.
    """
    columns = [c for c in df.columns if c.lower().startswith(prefix)]
    if not columns:
        raise ValueError(f"no column begins with {prefix!r}")
    labels = F.filter(F.array(*columns), lambda x: x.isNotNull() & (x != ""))
    out = df.select(F.lower(ngram).alias("ngram"), labels.alias("labels"), F.col(order).alias("o"))
    return out.where(F.size("labels") > 0).groupBy("ngram").agg(F.max_by("labels", "o").alias("labels"))


def words_with_places(text: Column, boundaries: str = BOUNDARIES) -> Column:
    """The words of a lower-cased text in order; each boundary character is one of its own."""
    cls = "".join(f"\\x{{{ord(c):x}}}" for c in boundaries)
    return F.regexp_extract_all(F.lower(text), F.lit(rf"([^\s{cls}]+|[^\s])"), F.lit(1))


def phrases(dictionary: DataFrame, boundaries: str = BOUNDARIES) -> DataFrame:
    """words, ngram (the words with one space between them), labels; phrases without a word go."""
    out = dictionary.select(words_with_places(F.col("ngram"), boundaries).alias("words"), "labels")
    return out.where(F.size("words") > 0).select("words", F.array_join("words", " ").alias("ngram"), "labels")


def phrase_trie(known: DataFrame) -> DataFrame:
    """node, word, below, ends: from the prefix ``node`` (empty at the root) ``word`` leads on; ``below`` words at most may follow, ``ends`` tells that a phrase is complete."""
    size = F.size("words")
    steps = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(F.array_join(F.slice("words", F.lit(1), i - 1), " ").alias("node"), F.get("words", i - 1).alias("word"), (size - i).alias("below")))
    return known.select(F.explode(steps).alias("s")).groupBy("s.node", "s.word").agg(F.max("s.below").alias("below"), (F.min("s.below") == 0).alias("ends"))


def matches(texts: DataFrame, key: str, text: str, dictionary: DataFrame, boundaries: str = BOUNDARIES) -> DataFrame:
    """key, s, e, ngram, labels of every dictionary phrase in a text, by word places from 1; ``key`` is distinct and not null.

    One round for each word of the longest phrase that is met; every round's table is written.
    """
    known, known_path = materialize(phrases(dictionary, boundaries), "phrases")
    trie, trie_path = materialize(phrase_trie(known), "phrase-trie")
    words, words_path = materialize(texts.select(key, words_with_places(F.col(text), boundaries).alias("words")), "phrase-words")
    first = trie.where("node = ''").select("word", "below", "ends")
    starts = words.select(key, F.posexplode("words").alias("at", "word")).join(first, "word").groupBy(key).agg(F.collect_list(F.struct((F.col("at") + 1).alias("s"), "below", "ends")).alias("starts"))
    begun = words.join(starts, key).select(key, "words", F.explode("starts").alias("x"))
    at, path = materialize(begun.select(key, "x.s", (F.col("x.s") + 1).alias("e"), F.get("words", F.col("x.s") - 1).alias("node"), "x.ends", F.slice("words", F.col("x.s") + 1, F.col("x.below")).alias("rest")), "phrase-runs")
    found, paths = [], [path]
    forget(texts.sparkSession, words_path)
    edge = trie.select(F.col("node").alias("__node"), F.col("word").alias("__word"), "below", F.col("ends").alias("__ends"))
    while True:
        found.append(at.where("ends").select(key, "s", "e", F.col("node").alias("ngram")))
        more = at.where(F.size("rest") > 0)
        on = (F.col("node") == F.col("__node")) & (F.get("rest", 0) == F.col("__word"))
        walked = more.join(edge, on).select(key, "s", (F.col("e") + 1).alias("e"), F.concat_ws(" ", "node", "__word").alias("node"), F.col("__ends").alias("ends"), F.slice("rest", F.lit(2), F.col("below")).alias("rest"))
        at, path = materialize(walked, "phrase-runs")
        paths.append(path)
        if at.isEmpty():
            break
    out, _ = materialize(reduce(DataFrame.unionByName, found).join(known.select("ngram", "labels"), "ngram").select(key, "s", "e", "ngram", "labels"), "phrase-matches")
    forget(texts.sparkSession, known_path, trie_path, *paths)
    return out


def leftmost_longest(found: Column) -> Column:
    """Of struct(s, e, ngram, labels) in an array, those that a scan from the left keeps, the longest at each place."""
    ordered = F.array_sort(F.transform(found, lambda m: F.struct(m["s"].alias("s"), (-m["e"]).alias("ne"), m["ngram"].alias("ngram"), m["labels"].alias("labels"))))
    kind = "array<struct<s:int,ne:int,ngram:string,labels:array<string>>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("kept"))
    step = lambda acc, m: F.when(m["s"] >= acc["at"], F.struct((-m["ne"]).alias("at"), F.concat(acc["kept"], F.array(m)).alias("kept"))).otherwise(acc)
    return F.aggregate(ordered, start, step, lambda acc: acc["kept"])


def label_texts(texts: DataFrame, key: str, text: str, dictionary: DataFrame, boundaries: str = BOUNDARIES) -> DataFrame:
    """key, label_list (sorted, distinct) of every row; texts without a match have an empty list.

    Equal texts are scanned once, whatever their keys; rows that share a key are texts of their own.
    """
    known = texts.select(F.col(text).alias("__text")).where(F.col("__text").isNotNull()).distinct()
    found = matches(known.withColumn("__h", F.sha2("__text", 256)), "__h", "__text", dictionary, boundaries)
    per = found.groupBy("__h").agg(F.collect_list(F.struct("s", "e", "ngram", "labels")).alias("m"))
    labelled = per.select("__h", F.array_sort(F.array_distinct(F.flatten(F.transform(leftmost_longest(F.col("m")), lambda m: m["labels"])))).alias("label_list"))
    return texts.select(key, F.sha2(text, 256).alias("__h")).join(labelled, "__h", "left").select(key, F.coalesce("label_list", F.array().cast("array<string>")).alias("label_list"))


def special_chars(df: DataFrame, text: str) -> DataFrame:
    """char: the distinct characters that are neither ASCII letters and digits nor white space."""
    return df.select(F.explode(F.array_distinct(F.split(F.regexp_replace(F.col(text), r"[a-zA-Z0-9\s]", ""), ""))).alias("char")).where("char <> ''").distinct()


def boundary_chars(df: DataFrame, text: str, ngrams: DataFrame, ngram: str = "ngram") -> DataFrame:
    """char: special characters of the corpus that begin or end no n-gram of the dictionary."""
    edges = ngrams.select(F.explode(F.array(F.substring(ngram, 1, 1), F.substring(ngram, -1, 1))).alias("char")).distinct()
    return special_chars(df, text).join(edges, "char", "left_anti")


def corpus_boundaries(df: DataFrame, text: str, ngrams: DataFrame, ngram: str = "ngram") -> str:
    """The boundary characters of a corpus as ``words_with_places`` takes them: no letters, digits or white space of any script.

    The driver gathers at most as many as there are characters.
    """
    chars = boundary_chars(df, text, ngrams, ngram).where(~F.col("char").rlike(r"[\p{L}\p{N}\s]"))
    return "".join(sorted(r["char"] for r in chars.collect()))


#: The label that blocks others, the one that says that a finding is absent, and the findings it contradicts.
BLOCKER, ABSENT, FINDINGS = "_LABEL_BLOCKER", "_assertion_absent", ["mass", "benign", "malignant"]


def label_pipeline(labels: Column, requirements: list[tuple[list[str], list[str]]] = (), blocker: str = BLOCKER, absent: str = ABSENT, findings: list[str] = FINDINGS) -> Column:
    """The fixed sequence behind dictionary labels: the blocker goes, absent findings go, then labels whose requirements are missing.

    ``requirements`` holds (checked labels, labels of which one is required), in order.
    """
    out = remove_incompatibilities(remove_label(labels, blocker), [absent], findings)
    out = remove_label(out, absent)
    for checked, required in requirements:
        out = check_requirements(out, checked, required)
    return out


def label_captions(texts: DataFrame, key: str, text: str, annotated: DataFrame, order: str, requirements: list[tuple[list[str], list[str]]] = (), boundaries: str | None = None) -> DataFrame:
    """key, label_list of every caption: annotations read, longest matches found, constraints applied.

    Words are parted by ``boundaries``, by default the characters of the captions that begin or end no annotated phrase.
    """
    dictionary = annotations(annotated, order)
    boundaries = corpus_boundaries(texts, text, dictionary) if boundaries is None else boundaries
    found = label_texts(texts, key, text, dictionary, boundaries)
    return found.withColumn("label_list", label_pipeline(F.col("label_list"), requirements))


def _overlap(labels: Column, group: list[str]) -> Column:
    return F.exists(labels, lambda x: x.isin(group))


def _without(labels: Column, group: list[str]) -> Column:
    return F.filter(labels, lambda x: ~x.isin(group))


def remove_label(labels: Column, label: str) -> Column:
    return F.array_remove(labels, label)


def remove_incompatibilities(labels: Column, one: list[str], other: list[str]) -> Column:
    """Where both groups occur, the labels of both go."""
    return F.when(_overlap(labels, one) & _overlap(labels, other), _without(labels, [*one, *other])).otherwise(labels)


def check_requirements(labels: Column, checked: list[str], required: list[str]) -> Column:
    """Where no required label occurs, the checked ones go."""
    return F.when(~_overlap(labels, required), _without(labels, checked)).otherwise(labels)


def exclusive_groups(labels: Column, predicted: Column, groups: list[list[str]]) -> Column:
    """An empty list where both lists together have more than one label of a group, else the labels."""
    both = F.array_union(labels, F.coalesce(predicted, F.array().cast("array<string>")))
    clash = F.lit(False)
    for g in groups:
        clash = clash | (F.size(F.array_intersect(both, F.array(*map(F.lit, g)))) > 1)
    return F.when(clash, F.array().cast("array<string>")).otherwise(labels)


def first_match(labels: Column, wanted: list[str], default: str = "") -> Column:
    """The last label that is wanted."""
    return F.coalesce(F.try_element_at(F.filter(labels, lambda x: x.isin(wanted)), F.lit(-1)), F.lit(default))


def replace_labels(labels: Column, mapping: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.transform(labels, lambda x: F.coalesce(table[x], x))


def add_compounds(labels: Column, compounds: dict[str, list[str]]) -> Column:
    """Append each compound whose components are all in the original list."""
    extra = [F.when(F.forall(F.array(*map(F.lit, parts)), lambda p: F.array_contains(labels, p)), F.lit(name)) for name, parts in compounds.items()]
    return F.concat(labels, F.filter(F.array(*extra), lambda x: x.isNotNull())) if extra else labels
