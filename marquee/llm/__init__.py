"""Operations of a training-data pipeline over documents and pages.

One module per operator; :mod:`marquee.llm.catalog` registers their queries.
Nothing outside this subpackage imports it.
"""
