"""Training-data operators: ten stand-alone jobs and the pipeline built from five of them."""
