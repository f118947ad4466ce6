"""corpusmill: a PySpark engine for preparing and examining text corpora.

Everything is expressed as DataFrame / SQL / Structured Streaming operators:

* ``corpusmill.functions``  - Column -> Column expressions (cleaning, scoring maths)
* ``corpusmill.operators``  - DataFrame -> DataFrame operators (vocabularies, codecs,
  token datasets, scored rows, run logs, text outputs)
* ``corpusmill.sources``    - readers and writers (corpus, tokens, manifests, vocabularies)
* ``corpusmill.plans``      - end-to-end plans (corpus -> token dataset, evaluation)
* ``corpusmill.streaming``  - Structured Streaming forms of cleaning, vocabulary, encoding
"""

from corpusmill.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
