"""Household cross-sell scoring as Spark DataFrame jobs.

Raw member x service-call rows go in; household features, propensity and cost
models, segments and offers come out.  Every operator is a plain function from
DataFrame to DataFrame.
"""
