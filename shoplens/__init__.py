"""shoplens: e-commerce interaction analytics and recommendations on Spark DataFrames.

Layers: raw (landed files) -> staged (typed) -> curated (joined, aggregated)
-> mart -> features -> models (tables) -> recommendations.  Every step is a
function from DataFrames to DataFrames; nothing runs until a sink is written.
"""
