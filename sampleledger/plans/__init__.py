"""Plans: tables of actions to take on files and samples. Nothing here touches a file."""
