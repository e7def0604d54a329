"""tomewise: Spark-native operators for rated review corpora.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a
``Column``) built from native Spark expressions, so Catalyst can prune,
push down and code-generate the whole chain.  Seeds are explicit so that
samples and splits repeat exactly.
"""

from tomewise.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
