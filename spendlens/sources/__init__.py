"""Where the tables come from: lake directories, cost exports, landing files, the sample binding."""
