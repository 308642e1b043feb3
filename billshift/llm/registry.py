"""The subpackage's queries and SQL, for the entry module."""

from billshift.llm import queries_corpus, queries_pairs, queries_rows, queries_samples, queries_texts

LLM_QUERIES = {
    **queries_corpus.QUERIES,
    **queries_pairs.QUERIES,
    **queries_rows.QUERIES,
    **queries_samples.QUERIES,
    **queries_texts.QUERIES,
}
LLM_ORACLE = {**queries_pairs.ORACLE, **queries_rows.ORACLE, **queries_samples.ORACLE}
