"""lodgelex: text analytics over nested rental-listing collections, as Spark jobs.

``sources``    readers, lexicons, stop words, derived tables
``functions``  column expressions (tokens, adjacent words, stems)
``operators``  one DataFrame-to-DataFrame step each
``plans``      what a user asks for: market reports and parameterised panels
"""
