"""Table preparation, class resampling, modelling and evaluation on Spark DataFrames."""
