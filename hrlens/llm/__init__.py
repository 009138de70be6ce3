"""Training-data operators: scoring, deduplication, decontamination, mixing, sharding and encoding of documents.

Every operator takes a ``documents``-like DataFrame (``doc_id``, ``text``; further columns are ignored unless a
docstring says otherwise) and returns a DataFrame.  Rules that hold for all of them:

- a NULL text is an empty text; a row with a NULL ``doc_id`` is a document like any other and sorts first;
- rows that repeat a ``doc_id`` are separate rows of the result;
- an empty table gives an empty result with the same columns;
- intermediate tables go to the folder of ``spark.checkpoint.dir``, never to a machine's own folder.
"""
