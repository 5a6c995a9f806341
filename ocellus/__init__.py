"""ocellus — image-classification data work as Spark DataFrame jobs.

Every public function takes DataFrames (and column names / parameters) and
returns a DataFrame; nothing collects data rows to the driver.  Driver-side
state is limited to model weights and class lists whose size is checked.
"""

__version__ = "0.1.0"
