from pyspark.ml.feature import StopWordsRemover

from lodestrata.operators.discourse import STOP_WORDS


def test_stop_words_are_the_published_list(spark):
    published = StopWordsRemover.loadDefaultStopWords("english")
    assert list(STOP_WORDS) == [w for w in published if w.isalpha() and len(w) >= 2]
