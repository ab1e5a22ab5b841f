"""The steps from raw inputs to recommendations, as lazy DataFrame plans."""
