"""From crawled pages or article text to a topic per article and its keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclens import storage
from topiclens.functions import text as text_fn
from topiclens.functions import words
from topiclens.functions.wordlists import STOP_WORDS
from topiclens.operators import articles as article_ops
from topiclens.operators import bags, terms, topics
from topiclens.operators.clusters import TopicModel

# Fixed value: number of topics of stemmed raw text.
STEMMED_K = 3


def crawl_to_articles(crawl: DataFrame) -> DataFrame:
    """`post_id, text`: the clean text of every page that was fetched and has any."""
    return article_ops.page_articles(crawl)


def corpus_lemmas(tokens: DataFrame) -> DataFrame:
    """`term, lemma` of the regular plurals whose singular is itself a term of the articles.

    From `post_id, tokens` or from bags.
    """
    if bags.is_bags(tokens):
        return terms.plurals_among(storage.settle(terms.distinct_terms(bags.terms_of(tokens))))
    terms_of = tokens.select(F.explode("tokens").alias("term"))
    return terms.plural_lemmas(terms_of)


def lemma_tokens(articles: DataFrame) -> DataFrame:
    """`post_id, tokens` in dictionary form, as far as the articles themselves tell it.

    Text is parsed once, for the terms and for the tokens.
    """
    tokens = storage.settle(article_ops.with_tokens(articles))
    return article_ops.with_lemmas(tokens, corpus_lemmas(tokens))


def lemma_bags(articles: DataFrame) -> DataFrame:
    """The bags of `lemma_tokens`, settled: text is parsed once, and each word looked up once a piece."""
    found = storage.settle(bags.of_articles(articles))
    return storage.settle(bags.with_terms(found, storage.settle(corpus_lemmas(found)), "lemma"))


def _article_bags(articles: DataFrame, lemmas: DataFrame | None) -> DataFrame:
    found = articles if bags.is_bags(articles) else storage.settle(bags.of_articles(articles))
    return found if lemmas is None else bags.with_terms(found, lemmas, "lemma")


def learn_topics(
    articles: DataFrame, lemmas: DataFrame | None = None, **settings
) -> TopicModel:
    """A model of `post_id, text`, or of its settled bags, which may have given the lemmas."""
    return topics.fit_topics(storage.settle(_article_bags(articles, lemmas)), **settings)


def label_articles(
    model: TopicModel, articles: DataFrame, lemmas: DataFrame | None = None
) -> DataFrame:
    """`post_id, topic` for old or new articles, with the lemmas the model was learnt with."""
    return topics.assign_topics(model, _article_bags(articles, lemmas))


def stemmed_tokens(articles: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """`post_id, tokens`: raw text, such as wiki lines, as a bag of word stems.

    Redirect lines are dropped. Counts are written once, for the distinct terms to be
    stemmed and for the stems to be put back.
    """
    lines = article_ops.not_redirect(articles)
    words = text_fn.remove_stop_words(text_fn.tokenize_alpha(F.col("text")), stop_words)
    counts = storage.settle(terms.term_counts(lines.select("post_id", words.alias("tokens"))))
    return terms.bags(terms.stem(counts), lines)


def stemmed_bags(articles: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """The bags of `stemmed_tokens`, settled: each distinct term is stemmed once, and its stem put
    back once a piece.

    Articles that share an id share their words there. Only these are put together by it here.
    """
    lines = article_ops.not_redirect(articles)
    shared = lines.groupBy("post_id").count().where("count > 1 OR post_id IS NULL")
    shared = storage.settle(shared.select(F.col("post_id").alias("shared_id")))
    same = F.col("post_id").eqNullSafe(F.col("shared_id"))
    some = not shared.isEmpty()
    alone = lines.join(shared, same, "left_anti") if some else lines
    text = F.regexp_replace("text", text_fn.INLINE_TAG, " ")
    found = storage.settle(bags.of_texts(alone, text, words.letter_words, stop_words))
    # Settled before anything filters stems: a filter would be pushed through all their steps.
    stems = storage.settle(terms.stem_terms(bags.terms_of(found)))
    made = bags.with_terms(found, stems, "stem")
    if some:
        together = stemmed_tokens(lines.join(shared, same, "left_semi"), stop_words)
        made = made.unionByName(bags.of_tokens(together))
    return storage.settle(made)


def learn_stemmed_topics(articles: DataFrame, k: int = STEMMED_K, **settings) -> TopicModel:
    """Topics of word stems.

    Every term counts, however rare it is, up to the `vocab_size` commonest (262,144 by
    default).
    """
    limits = {"min_df": 1.0, "min_tf": 1.0, "vocab_size": 1 << 18, "max_iter": 20}
    return topics.fit_topics(stemmed_bags(articles), k=k, **{**limits, **settings})


def weighted_terms(articles: DataFrame) -> DataFrame:
    """`post_id, term, tf, tfidf` in long form, from whole article texts.

    The counts are read twice, for the vocabulary and for the weights, so they are
    settled: text is parsed a single time.
    """
    counts = storage.settle(terms.term_counts(lemma_tokens(articles)))
    return terms.tfidf(counts, terms.vocabulary(counts), articles)


def topic_keywords(articles: DataFrame, topic_map: DataFrame, top_k: int = 10) -> DataFrame:
    """The strongest terms of each topic of an existing topic map."""
    return topics.top_terms(topics.centroids(weighted_terms(articles), topic_map), top_k)
